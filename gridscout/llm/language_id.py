"""Language identification as a mixture: which languages a document is written in, and in what shares.

Each language has a distribution of byte trigrams, learned from labelled documents. The trigrams of a
word (with a blank at either side) give the word's likelihood in every language. A document's words are
draws from a mixture of languages; expectation-maximisation finds the shares. Sets of one, two, ...
languages are compared by log-likelihood less half the log of the number of words for each further
share, and the best set's shares are the result. Sets grow up to all languages; a document is left out of further
sizes only once no mixture at all could make up for the next size's penalty.

The model, languages x 65,536 numbers, is broadcast; more than `most_langs` languages raise an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscout.llm import words as W
from gridscout.llm.common import held_out, unique_texts

GRAM_BITS = 16
MOST_LANGS = 256
ROUNDS = 12
PENALTY = 1.0
ALPHA = 0.5
UNKNOWN = "und"


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most_langs: int = MOST_LANGS) -> tuple[list[str], np.ndarray]:
    """(languages, log-likelihoods: languages x grams) from all rows with a text and a language."""
    labelled = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    langs = sorted(r.lang for r in labelled.select("lang").distinct().limit(most_langs + 1).collect())
    if len(langs) > most_langs:
        raise ValueError(f"more than {most_langs} languages in {lang_col}")
    counts = labelled.mapInArrow(_count(langs), "lang int, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((len(langs), 1 << GRAM_BITS))
    table[counts.column("lang").to_numpy(), counts.column("gram").to_numpy()] = counts.column("n").to_numpy()
    table += ALPHA
    return langs, np.log(table / table.sum(1, keepdims=True)).astype(np.float32)


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    modulus: int = 4,
    rest: int = 2,
    penalty: float = PENALTY,
    most_langs: int = MOST_LANGS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(id, held_out, lang_pred, score, langs, shares, text, carry...) per document.

    Learns from the documents whose crc32(id as text) mod `modulus` is not `rest`. `langs`: the chosen
    languages, by share, and `shares`. lang_pred: the language of the largest share (of equal ones, the
    first in alphabetical order), score: that share. A language is never predicted from anything but
    the text.

    A null, empty or letterless text is "und" with score 0 and no languages; so is every text if no
    document has a language to learn from. Texts and languages that are null teach nothing. Several rows
    of one id count as one, see `unique_texts`; rows without an id are left out. An empty table gives an
    empty table. Other columns of `docs` play no part, whatever they are called.
    """
    names = tuple(dict.fromkeys((lang_col, *carry)))
    rows = unique_texts(docs, id_col, text_col, *names).withColumns({"_held": held_out(id_col, modulus, rest), "_letters": F.coalesce(F.col(text_col).rlike("\\p{L}"), F.lit(False))})
    langs, model = learn(rows.where(~F.col("_held")), text_col, lang_col, most_langs)
    shared = rows.sparkSession.sparkContext.broadcast((langs, model))
    keep = [id_col, "_held", text_col, *carry]
    types = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    out = rows.select(*keep, "_letters").mapInArrow(
        _predict(shared, text_col, keep, penalty), f"{types}, _lang string, _score double, _langs array<string>, _shares array<double>"
    )
    return out.select(
        id_col, F.col("_held").alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"), F.col("_langs").alias("langs"), F.col("_shares").alias("shares"), text_col, *carry
    )


def grams(data: np.ndarray, offsets: np.ndarray):
    """(gram of each word byte, first byte of each word among them, word bounds of the rows)."""
    data = W.LOWER[data]
    starts, ends, bounds = W.find_words(data, offsets)
    inside = W.NON_SPACE[data]
    left, right = np.empty_like(data), np.empty_like(data)
    left[1:], right[:-1] = data[:-1], data[1:]
    left[starts], right[ends - 1] = 0x20, 0x20
    code = left.astype(np.uint32) << np.uint32(16) | data.astype(np.uint32) << np.uint32(8) | right
    code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAM_BITS)
    sizes = ends - starts
    return code[inside], np.cumsum(sizes) - sizes, bounds


def _count(langs: list[str]):
    number = {x: i for i, x in enumerate(langs)}

    def run(batches):
        counts = np.zeros((len(langs), 1 << GRAM_BITS), np.int64)
        for batch in batches:
            of = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            for lo, hi, data, offsets in W.sliced(batch.column("text")):
                if not len(data):
                    continue
                code, first, bounds = grams(data, offsets)
                if not len(code):
                    continue
                sizes = np.concatenate([[0], np.cumsum(np.diff(first, append=len(code)))])[bounds]
                for lang in np.unique(of[lo:hi]):
                    own = np.repeat(of[lo:hi] == lang, np.diff(sizes))
                    counts[lang] += np.bincount(code[own], minlength=1 << GRAM_BITS)
        lang, gram = np.nonzero(counts)
        if len(lang):
            yield pa.record_batch([pa.array(lang, pa.int32()), pa.array(gram, pa.int32()), pa.array(counts[lang, gram])], ["lang", "gram", "n"])

    return run


def shares_of(likelihood: np.ndarray, begins: np.ndarray, rows: np.ndarray, sizes: np.ndarray, start: np.ndarray, rounds: int = ROUNDS):
    """EM: (shares: rows x languages, log-likelihood per row), from likelihoods of words x languages.
    A share that starts at 0 stays there."""
    shares = start
    for _ in range(rounds):
        part = likelihood * shares[rows]
        total = part.sum(1, keepdims=True)
        part /= np.maximum(total, 1e-30)
        shares = np.add.reduceat(part, begins, axis=0) / sizes[:, None]
    total = (likelihood * shares[rows]).sum(1)
    return shares, np.add.reduceat(np.log(np.maximum(total, 1e-30)), begins)


def highest(likelihood: np.ndarray, begins: np.ndarray, rows: np.ndarray, sizes: np.ndarray, shares: np.ndarray, value: np.ndarray) -> np.ndarray:
    """What the log-likelihood of no mixture exceeds, from any shares and their log-likelihood: it is concave in the
    shares, so it lies below its tangent there."""
    total = np.maximum((likelihood * shares[rows]).sum(1, keepdims=True), 1e-30)
    return value + (np.add.reduceat(likelihood / total, begins, axis=0).max(1) - sizes) + 1e-3 * np.maximum(sizes, 1)


def mixtures(likelihood: np.ndarray, base: np.ndarray, bounds: np.ndarray, penalty: float) -> np.ndarray:
    """The shares of the best language set of each row; every row has a word.

    likelihood: words x languages, each word's largest being 1; base: the log of what it was divided by.
    """
    sizes, begins = np.diff(bounds).astype(np.float32), bounds[:-1]
    rows = np.repeat(np.arange(len(sizes)), np.diff(bounds))
    n_langs = likelihood.shape[1]
    logs = np.add.reduceat(np.log(np.maximum(likelihood, 1e-30)), begins, axis=0)
    single = np.argmax(logs, 1)
    best = np.zeros((len(sizes), n_langs), np.float32)
    best[np.arange(len(sizes)), single] = 1
    value = logs[np.arange(len(sizes)), single]
    if n_langs > 1:
        full, reached = shares_of(likelihood, begins, rows, sizes, np.full((len(sizes), n_langs), 1 / n_langs, np.float32))
        most = highest(likelihood, begins, rows, sizes, full, reached)
        order = np.argsort(-full, 1, kind="stable")
        cost = penalty * 0.5 * np.log(np.maximum(sizes, 2))
        for size in range(2, n_langs + 1):
            open_ = np.flatnonzero(most - (size - 1) * cost > value)
            if not len(open_):
                break
            if len(open_) < len(order):
                words = np.isin(rows, open_)
                own, lengths = likelihood[words], np.diff(bounds)[open_]
            else:
                own, lengths = likelihood, np.diff(bounds)
            start = np.zeros((len(open_), n_langs), np.float32)
            chosen = order[open_, :size]
            np.put_along_axis(start, chosen, np.maximum(np.take_along_axis(full[open_], chosen, 1), 1e-6), 1)
            start /= start.sum(1, keepdims=True)
            shares, found = shares_of(own, np.cumsum(lengths) - lengths, np.repeat(np.arange(len(open_)), lengths), sizes[open_], start, ROUNDS // 2)
            found = found - (size - 1) * cost[open_]
            better = found > value[open_]
            best[open_[better]], value[open_[better]] = shares[better], found[better]
    return best


def _predict(shared, text_col: str, keep: list[str], penalty: float):
    def of_slice(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray):
        langs, model = shared.value
        out: list[tuple] = [(UNKNOWN, 0.0, [], [])] * len(letters)
        if not langs or not letters.any():
            return out
        code, first, bounds = grams(data, offsets)
        logs = np.stack([np.add.reduceat(m[code], first) for m in model], 1)
        base = logs.max(1, keepdims=True)
        likelihood = np.exp(logs - base)
        rows = np.flatnonzero(letters)
        some = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in rows]) if len(rows) < len(letters) else slice(None)
        own = np.concatenate([[0], np.cumsum(np.diff(bounds)[rows])])
        for row, shares in zip(rows, mixtures(likelihood[some], base[some], own, penalty), strict=True):
            order = [i for i in np.argsort(-shares, kind="stable") if shares[i] > 0]
            out[row] = (langs[order[0]], min(1.0, float(shares[order[0]])), [langs[i] for i in order], [float(shares[i]) for i in order])
        return out

    def run(batches):
        for batch in batches:
            letters = batch.column("_letters").to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in W.sliced(batch.column(text_col)):
                lang, score, langs, shares = zip(*of_slice(data, offsets, letters[lo:hi]), strict=True)
                columns = {c: batch.column(c).slice(lo, hi - lo) for c in keep}
                columns |= {"_lang": pa.array(lang, pa.string()), "_score": pa.array(score, pa.float64())}
                columns |= {"_langs": pa.array(langs, pa.list_(pa.string())), "_shares": pa.array(shares, pa.list_(pa.float64()))}
                yield pa.RecordBatch.from_pydict(columns)

    return run

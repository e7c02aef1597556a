import random
import zlib

import numpy as np
import pytest
from tests.llm.cases import awkward_rows, awkward_texts, frame, prose
from tokenizers import Tokenizer

from gridscout.llm import word_ids as I
from gridscout.llm.packing import Plan, pack
from gridscout.llm.queries import tokenizer


def token_ids(texts: list[bytes], path: str) -> list[bytes]:
    offsets = np.cumsum([0, *map(len, texts)])
    ids, bounds = I.word_ids(path).of(np.frombuffer(b"".join(texts), np.uint8), offsets)
    return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]


def pieces_of(texts, capacity):
    model = Tokenizer.from_file(tokenizer())
    out = {}
    for i, text in texts.items():
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            own = np.array(ids[at : at + capacity], "<u4")
            out[i, piece] = (at, len(own), zlib.crc32(own.tobytes()))
    return out


def check_sequences(rows, capacity, most_docs=None, most_cost=None):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in by_sequence.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
        assert most_docs is None or len(members) <= most_docs
        assert most_cost is None or sum(n * n for _, n in members) <= most_cost
    return len(by_sequence)


def test_awkward_rows(spark):
    rows = pack(frame(spark, awkward_rows()), tokenizer(), capacity=256).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == pieces_of(awkward_texts(), 256)
    assert len(rows) == len(pieces_of(awkward_texts(), 256))
    check_sequences(rows, 256)


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_every_capacity_holds(spark, score):
    texts = {i: prose(i, random.Random(i).randrange(1, 70)) for i in range(300)}
    docs = frame(spark, list(texts.items()))
    rows = pack(docs, tokenizer(), capacity=512, most_docs=3, most_cost=512 * 300, score=score).collect()
    check_sequences(rows, 512, 3, 512 * 300)
    assert sum(r.length for r in rows) == sum(x[1] for x in pieces_of(texts, 512).values())


def test_close_to_the_least_number_of_sequences(spark):
    texts = {i: prose(i, random.Random(i).randrange(1, 400)) for i in range(400)}
    rows = pack(frame(spark, list(texts.items())), tokenizer()).collect()
    n = check_sequences(rows, 2048)
    assert n <= 1 + 1.01 * sum(r.length for r in rows) / 2048


def test_ids_come_with_the_pieces(spark):
    (row,) = pack(frame(spark, [(5, "hello")]), tokenizer(), with_ids=True).collect()
    assert zlib.crc32(bytes(row.ids)) == row.ids_crc32 and len(row.ids) == 4 * row.length


def test_plan_places_every_rank_once():
    rng = random.Random(2)
    lengths = {n: rng.randrange(1, 50) for n in rng.sample(range(1, 65), 30)}
    plan = Plan(lengths, 64, 64, 64**2, (1.0, 0.001, 0.001), "norm")
    used = {}
    for n, count in lengths.items():
        sequence, offset = plan.place(np.full(count, n), np.arange(count))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            used.setdefault(s, []).append((o, n))
    assert len(used) == plan.sequences
    for members in used.values():
        members.sort()
        assert members[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(members, members[1:]))
        assert sum(n for _, n in members) <= 64
    with pytest.raises(ValueError):
        Plan({10: 1}, 64, 64, 99, (1, 1, 1), "norm")


def test_words_give_the_ids_of_the_text():
    model = Tokenizer.from_file(tokenizer())
    rng = random.Random(4)
    parts = ["it's", "we'll", "A$$$", "12,5", "é", "é", "́x", "ΣΣ", "İ", " ", "　", "\x85", "\x1c", "<|endoftext|>", "日本", "\U0001f600", " ", "\n", "\t", "\x0b", "'", "don't", "Ŀ", "ŉ", "ſ", "×", "÷", "ß", "Ǆ", "ª", "µ", "'S", "'ll", "<|", "ñ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(3000)]
    expected = [np.array(model.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert token_ids([t.encode() for t in texts], tokenizer()) == expected


def test_units_with_one_hash_are_told_apart(monkeypatch):
    model = Tokenizer.from_file(tokenizer())
    text = "alpha beta gamma delta epsilon 12 é"
    expected = np.array(model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    found = I.WordIds(tokenizer())
    data, offsets = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())])
    monkeypatch.setattr(I.W, "hash_words", lambda text, starts, ends: (ends - starts).astype(np.uint64))
    for _ in range(2):
        ids, bounds = found.of(data, offsets)
        assert ids.tobytes() == expected and bounds.tolist() == [0, len(ids)]


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr(I, "MOST_UNITS", 50)
    found, model = I.WordIds(tokenizer()), Tokenizer.from_file(tokenizer())
    for k in range(20):
        text = prose(k, 30) + f" unit{k} x{k}y"
        ids, _ = found.of(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
        assert ids.tolist() == model.encode(text, add_special_tokens=False).ids and len(found.keys) <= 50


def test_empty_table(spark):
    assert pack(frame(spark, []), tokenizer()).collect() == []

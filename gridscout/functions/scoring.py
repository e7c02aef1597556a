"""The BM25 formula as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Term-frequency saturation and length normalisation.
K1 = 1.2
B = 0.75

# Contributions are added as whole multiples of 1 / SCALE, so that a score does not depend on
# the order in which tasks happen to add them up.
SCALE = 10_000_000_000


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def saturation(tf: Column, length: Column, mean_length: Column) -> Column:
    return tf / (tf + K1 * (1 - B + B * length / mean_length))


def to_units(score: Column) -> Column:
    return F.round(score * SCALE).cast("long")


def from_units(units: Column) -> Column:
    return units / F.lit(float(SCALE))

"""Scores, confidences and small formulas."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Count and confidence tiers of relation triples.
TRIPLE_TIERS = ((10, 0.7), (5, 0.5), (2, 0.3), (1, 0.2))
#: Factors of arguments by mention type.
MENTION_FACTORS = {"name": 1.0, "desc": 0.75}


def tier(count: Column) -> Column:
    """Confidence of a relation by how often its triple occurs in the corpus."""
    out = F.when(count >= TRIPLE_TIERS[0][0], TRIPLE_TIERS[0][1])
    for least, value in TRIPLE_TIERS[1:]:
        out = out.when(count >= least, value)
    return out.otherwise(0.1)


def actor_score(count: Column, cap: float = 40, top: float = 0.95, floor: float = 0.5) -> Column:
    """top * min(count / cap, 1), at least ``floor``."""
    return F.greatest(F.lit(top) * F.least(count / cap, F.lit(1.0)), F.lit(floor))


def argument_score(score: Column, mention_type: Column, linked: Column) -> Column:
    by_type = F.when(mention_type == "name", 1.0).when(mention_type == "desc", 0.75).otherwise(0.5)
    return score * by_type * F.when(linked, 1.0).otherwise(0.75)


def f1(p: Column, r: Column) -> Column:
    return F.when((p == 0) | (r == 0), 0.0).otherwise(2 * p * r / (p + r))


def angular_to_cosine(d: Column) -> Column:
    """Cosine of unit vectors whose Euclidean distance is d."""
    return 1 - d * d / 2


def group_similarity(total: Column, n: Column) -> Column:
    """Average similarity of the ordered pairs of a group; one for a single member."""
    return F.when(n == 1, 1.0).otherwise(total / (n * (n - 1)))


def wu_palmer(n1: Column, n2: Column, n3: Column) -> Column:
    """Similarity of two concepts: n1, n2 steps to their common ancestor, which is n3 below the root."""
    return 2 * n3 / (n1 + n2 + 2 * n3)


def hamming_to_cosine(bits_differing: Column, bits: int) -> Column:
    """Cosine that sign hashes suggest: cos(pi * share of differing bits)."""
    return F.cos(F.lit(3.141592653589793) * bits_differing / bits)


def decayed(weight: Column, depth: Column, decay: float) -> Column:
    """Weight of an exemplar at an ancestor ``depth`` levels up."""
    return weight * F.exp(-decay * depth)


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))

"""Joins of spans, neighbours and texts between them. Spans are closed: start and end both belong to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return (a_start <= b_end) & (b_start <= a_end)


def contains(outer_start: Column, outer_end: Column, start: Column, end: Column) -> Column:
    return (outer_start <= start) & (end <= outer_end)


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], width: int, left_span: tuple[str, str], right_span: tuple[str, str]) -> DataFrame:
    """Pairs of rows of equal keys whose spans overlap, by an equi-join on buckets of ``width`` and not by a product.

    A span lies in every bucket that it touches; a pair is kept in the bucket of the later start alone, so it comes once.
    Column names of the two sides must differ but for the keys.
    """
    bucket = lambda c: F.floor(F.col(c) / width)
    a = left.withColumn("_b", F.explode(F.sequence(bucket(left_span[0]), bucket(left_span[1]))))
    b = right.withColumn("_b", F.explode(F.sequence(bucket(right_span[0]), bucket(right_span[1]))))
    ls, le, rs, re = (F.col(c) for c in (*left_span, *right_span))
    first = F.floor(F.greatest(ls, rs) / width)
    return a.join(b, [*keys, "_b"]).where(overlaps(ls, le, rs, re) & (F.col("_b") == first)).drop("_b")


def covering_sentence(points: DataFrame, sentences: DataFrame, keys: list[str], width: int, span: tuple[str, str], sentence_span: tuple[str, str]) -> DataFrame:
    """points with the sentence that contains the whole span."""
    pairs = overlap_join(points, sentences, keys, width, span, sentence_span)
    return pairs.where(contains(F.col(sentence_span[0]), F.col(sentence_span[1]), F.col(span[0]), F.col(span[1])))


def nearest(pairs: DataFrame, target: list[str], distance: Column, limit: int, tie: list[str]) -> DataFrame:
    """For each target the candidate at the least distance up to ``limit``; ties by the columns of ``tie``."""
    order = W.partitionBy(*target).orderBy(distance, *tie)
    return pairs.where(distance <= limit).withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")


def gap_text(text: Column, a_end: Column, b_start: Column) -> Column:
    """Text strictly between two spans (ends from 0, inclusive)."""
    return F.substring(text, a_end + 2, F.greatest(b_start - a_end - 1, F.lit(0)))


def mark_up(text: Column, start: Column, end: Column) -> Column:
    """Double brackets around a span (from 0, end inclusive)."""
    return F.concat(F.substring(text, 1, start), F.lit("[["), F.substring(text, start + 1, end - start + 1), F.lit("]]"), F.substring(text, end + 2, F.length(text)))

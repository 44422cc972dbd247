"""Benchmark decontamination by canonical templates, with DataFrame operations only.

Words of a text become a template: numbers and number words, names, and units after a number are replaced by typed
placeholders. A name is a given name of a list or any capitalised word; as the case of a copy may differ, windows of items, and
of documents in which a quarter of the words is capitalised, are also made from words in lower case, where only listed names
are names. Windows of template words are hashed, at every place of items and documents. Pass one hash-joins the documents' windows with the items' windows and keeps the documents that share
one. Pass two looks at every window of those documents, lines the matches up with the item, and checks the slots: along one
alignment each value of the item must stand for one value of the document and the other way round, as it does when a
question was re-parameterised and as it does when it was copied.

A pair needs a certain number of an item's windows, so it shares at least one of the rarest: candidates are joined on each
item's rarest windows alone, and wording that all items begin with makes no candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from factloom.llm.names import GIVEN, NUMBER_WORDS, UNITS
from factloom.llm.runtime import cut, free, row_key

#: Words of a window. Items below WINDOW words have windows of SHORT words; an item
#: below SHORT words is found only where it is a whole text, as so few words stand in any prose.
WINDOW, SHORT = 8, 5
NUMBER, NAME, UNIT = "#n", "#a", "#u"
_BREAK = r"[^\p{L}\p{N}.,]+|[.,](?![0-9])|(?<![0-9])[.,]|(?<=[0-9])(?=\p{L})"
_NAMES = sorted({n.lower() for names in GIVEN.values() for n in names})
_WINDOWS = "array<struct<pos: int, size: int, h: bigint>>"


_SPECIAL = sorted({*_NAMES, *NUMBER_WORDS, *UNITS})


def _bound(value: Column, f) -> Column:
    """f(value) with the value computed once: a column that is named inside of a lambda may be put there as an expression
    and computed again for each element; a variable of an outer lambda is not."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _is_number(t: Column) -> Column:
    return (t >= "0") & (t < ":") | t.isin(NUMBER_WORDS)


def _lower_template(w: Column) -> Column:
    """Words in lower case with placeholders; only listed names are names."""

    def one(t: Column, i: Column) -> Column:
        plain = ~t.isin(_SPECIAL) & ~((t >= "0") & (t < ":"))
        return F.when(plain, t).when(_is_number(t), NUMBER).when(t.isin(_NAMES), NAME).when((i > 0) & _is_number(F.get(w, i - 1)), UNIT).otherwise(t)

    return F.transform(w, one)


def _template(raw: Column, lower: Column) -> Column:
    """The same with every capitalised word as a name. lower: the template of the words in lower case."""

    def one(r: Column, t: Column) -> Column:
        return F.when((r >= "a") & (r < "{") | (r < "A"), t).when((F.length(r) > 1) & (r != F.lower(r)) & (r == F.initcap(F.lower(r))), NAME).otherwise(t)

    return F.zip_with(raw, lower, one)


def _templates(text: Column) -> Column:
    """struct<w, t, u>: words in lower case, templates with and without capitalised words as names."""
    raw = F.array_remove(F.split(F.coalesce(text, F.lit("")), _BREAK), "")

    def made(r: Column) -> Column:
        return _bound(F.transform(r, lambda x: F.lower(x)), lambda w: _bound(_lower_template(w), lambda u: F.struct(w.alias("w"), _template(r, u).alias("t"), u.alias("u"))))

    return _bound(raw, made)


def _windows(words: Column, size: int, places: bool = True) -> Column:
    """(pos, size, h), or h alone: windows of ``size`` words at every place; none for fewer words. words: a bound variable."""

    def one(i: Column) -> Column:
        h = F.xxhash64(F.slice(words, i + 1, size))
        return F.struct(i.alias("pos"), F.lit(size).alias("size"), h.alias("h")) if places else h

    n = F.size(words) - size
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), n), one)).otherwise(F.array().cast(_WINDOWS if places else "array<bigint>"))


def _whole(words: Column, places: bool = True) -> Column:
    """The one window of a text below the shortest window; its hash differs from that of any other window."""
    h = F.xxhash64(words, F.lit("whole"))
    return F.array(F.struct(F.lit(0).alias("pos"), F.size(words).alias("size"), h.alias("h")) if places else h)


def _in_text(x: Column, text: Column, sizes: list[int], short: int, places: bool = True) -> Column:
    """Windows of a text's template, and of the other one if a quarter of the words is capitalised. x: its ``_templates``, bound."""

    def made(words: Column) -> Column:
        parts = [_windows(words, n, places) for n in sizes]
        long = F.concat(*parts) if parts else F.array().cast(_WINDOWS if places else "array<bigint>")
        return F.when(F.size(words) == 0, F.array().cast(_WINDOWS if places else "array<bigint>")).when(F.size(words) < short, _whole(words, places)).otherwise(long)

    heavy = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\p{Lu}\p{Ll}")) * 4 > F.size(x["t"])
    return F.when(heavy, F.concat(_bound(x["t"], made), _bound(x["u"], made))).otherwise(_bound(x["t"], made))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, min_coverage: float = 0.5, min_run: int = 6,
) -> DataFrame:
    """(id_col, item_col, n_windows, item_windows, coverage, n_slots, row_key): documents and the items they hold.

    n_windows: windows of the item that the document has in alignments with consistent slots. A pair is returned if they are
    at least ``min_coverage`` of the item's windows, or ``min_run`` (that is, 13 template words of the item). Items below
    ``window`` words have windows of SHORT words, and one below SHORT words matches texts that are nothing else. Null texts
    and texts without words match nothing. Repeated rows and a null id are told apart by id and
    text: equal rows give one pair. Windows of which over half are placeholders are left out, as tables of numbers would
    match them. row_key: 128 bits of the row's id and text. Other columns, whatever their names, are not read.
    """
    key = row_key(id_col, text_col)
    short = min(SHORT, window)
    items = benchmark.select(F.col(f"`{item_col}`").alias("item"), _templates(F.col(f"`{item_text_col}`")).alias("x")).select("item", "x.*").where(F.size("w") > 0)

    def of_item(words: Column) -> Column:
        return _bound(words, lambda a: F.when(F.size(a) >= window, _windows(a, window)).when(F.size(a) >= short, _windows(a, short)).otherwise(_whole(a)))

    parts = [items.select("item", "w", F.col(shape).alias("shape"), F.inline(of_item(F.col(shape)))) for shape in ("t", "u")]
    entries = parts[0].union(parts[1]).withColumnRenamed("pos", "ipos")
    raw, shape = F.slice("w", F.col("ipos") + 1, F.col("size")), F.slice("shape", F.col("ipos") + 1, F.col("size"))
    entries = entries.select("item", "ipos", "size", "h", raw.alias("iraw"), shape.alias("ishape"))
    entries = entries.where(F.size(F.filter("ishape", lambda t: t.startswith("#"))) * 2 <= F.col("size"))
    # How many items have a window, and each item's windows by that, the rarest first.
    spread = entries.groupBy("h").agg(F.countDistinct("item").alias("items"))
    entries = cut(entries.dropDuplicates(["item", "ipos", "h"]).join(spread, "h"))
    places = entries.groupBy("item", "ipos").agg(F.max("items").alias("items"))
    totals = places.groupBy("item").agg(F.count("*").alias("item_windows"))
    needed = F.least(F.lit(min_run), F.greatest(F.ceil(min_coverage * F.col("item_windows") - 1e-5), F.lit(1)))
    ranked = places.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy("items", "ipos"))).join(totals, "item")
    rare = cut(entries.join(ranked.where(F.col("rank") <= F.col("item_windows") - needed + 1).select("item", "ipos"), ["item", "ipos"], "left_semi").select("item", "h"))

    sizes = {r["size"] for r in entries.select("size").distinct().collect()}  # window, SHORT and what is below: a few values
    long = sorted({window, short} & sizes)
    text = F.col(f"`{text_col}`")
    hashed = docs.select(key.alias("k"), F.explode(_bound(_templates(text), lambda x: _in_text(x, text, long, short, places=False))).alias("h"))
    found = cut(hashed.join(rare.select("h").distinct(), "h", "left_semi").select("k").distinct())

    near = docs.select(F.col(f"`{id_col}`").alias("id"), key.alias("k"), text.alias("text")).join(found, "k", "left_semi").dropDuplicates(["k"])
    made = _bound(_templates(F.col("text")), lambda x: F.struct(x["w"].alias("w"), _in_text(x, F.col("text"), long, short).alias("windows")))
    at = near.select("id", "k", made.alias("m")).select("id", "k", F.col("m.w").alias("w"), F.inline("m.windows"))
    at = cut(at.select("id", "k", "pos", "h", F.slice("w", F.col("pos") + 1, F.col("size")).alias("raw")).join(entries.select("h").distinct(), "h", "left_semi"))
    pairs = at.select("k", "h").join(rare, "h").select("k", "item").distinct()
    hits = pairs.join(entries, "item").join(at, ["k", "h"]).select("id", "k", "item", "ipos", (F.col("pos") - F.col("ipos")).alias("shift"), "raw", "iraw", "ishape")
    # Slots of a window: kind and both values. Windows of one alignment overlap, so the sets are joined.
    slots = F.filter(F.arrays_zip("ishape", "iraw", "raw"), lambda s: s["ishape"].startswith("#"))
    runs = hits.groupBy("id", "k", "item", "shift").agg(F.collect_set("ipos").alias("places"), F.array_distinct(F.flatten(F.collect_set(slots))).alias("slots"))
    of = lambda side: F.size(F.array_distinct(F.transform("slots", lambda s: F.struct(s["ishape"].alias("a"), s[side].alias("b")))))
    runs = runs.where((F.size("slots") == of("iraw")) & (F.size("slots") == of("raw")))
    pairs = runs.groupBy("id", "k", "item").agg(F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("long").alias("n_windows"), F.max(F.size("slots")).cast("long").alias("n_slots"))
    out = pairs.join(totals, "item").withColumn("coverage", F.round(F.col("n_windows") / F.col("item_windows"), 6))
    out = out.where((F.col("coverage") >= min_coverage) | (F.col("n_windows") >= min_run))
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "n_windows", F.col("item_windows").cast("long").alias("item_windows"), "coverage", "n_slots", F.col("k").alias("row_key"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs without the rows that hold a benchmark item; rows of one id that differ in text are judged apart."""
    (own,) = free(docs, "_k")
    gone = contaminated(docs, benchmark, id_col, text_col, **options).select(F.col("row_key").alias(own)).distinct()
    return docs.withColumn(own, row_key(id_col, text_col)).join(gone, own, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])

"""Writers: JSON-LD, N-Triples, tables. They only shape rows; Spark writes the files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def ntriples_line(base: str) -> Column:
    """An N-Triples line of (s, p, o); an object with a slash and no space is a node."""
    node = lambda c: F.concat(F.lit(f"<{base}"), c, F.lit(">"))
    literal = F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace("o", r"\\", r"\\\\"), '"', r'\\"'), F.lit('"'))
    return F.concat(node(F.col("s")), F.lit(" "), node(F.col("p")), F.lit(" "), F.when(F.col("o").rlike("^[a-z]+/[^ ]+$"), node(F.col("o"))).otherwise(literal), F.lit(" ."))


def write_ntriples(triples: DataFrame, path: str, base: str) -> None:
    triples.select(ntriples_line(base)).write.mode("overwrite").text(path)


def jsonld(extractions: DataFrame, doc: str, value: str, context: str = "urn:factloom") -> DataFrame:
    """(doc, document): one JSON-LD object for each document."""
    body = F.struct(F.lit(context).alias("@context"), F.col(doc).cast("string").alias("@id"), F.col("extractions"))
    return extractions.groupBy(doc).agg(F.sort_array(F.collect_list(value)).alias("extractions")).select(doc, F.to_json(body).alias("document"))


def relation_id(left: Column, kind: Column, right: Column) -> Column:
    return F.concat_ws("#", left.cast("string"), kind, right.cast("string"))


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").csv(path)


def write_by(df: DataFrame, path: str, *columns: str) -> None:
    """JSON files in a folder for each value of the columns."""
    df.repartition(*columns).write.mode("overwrite").partitionBy(*columns).json(path)


#: Relation types that become one direct triple for each pair of instances.
DIRECT = {"before": "precedes", "contains": "contains", "part_of": "part_of"}


def event_triples(events: DataFrame, event: str, kind: str, arguments: str, extra: dict[str, str]) -> DataFrame:
    """(s, p, o) of events: type, one triple for each argument (array of role and filler), further columns as properties."""
    s = F.concat(F.lit("event/"), F.col(event).cast("string")).alias("s")
    fixed = F.array(F.struct(F.lit("type").alias("p"), F.col(kind).cast("string").alias("o")), *[F.struct(F.lit(p).alias("p"), F.col(c).cast("string").alias("o")) for p, c in extra.items()])
    roles = F.transform(F.coalesce(arguments, F.array()), lambda a: F.struct(a["role"].alias("p"), a["filler"].cast("string").alias("o")))
    return events.select(s, F.inline(F.concat(fixed, roles))).where("o IS NOT NULL")


def causal_assertions(relations: DataFrame, instances: DataFrame, relation: str, kind: str, ends: tuple[str, str], event: str, instance: str, strength: str, direct: dict[str, str] = DIRECT) -> DataFrame:
    """(s, p, o): direct triples for types in ``direct``, else an assertion node for each relation with its ends and properties."""
    mapped = F.create_map(*[F.lit(x) for kv in direct.items() for x in kv])[F.col(kind)]
    r = relations.withColumn("_p", mapped)
    left = instances.select(F.col(event).alias(ends[0]), F.col(instance).cast("string").alias("s"))
    right = instances.select(F.col(event).alias(ends[1]), F.col(instance).cast("string").alias("o"))
    plain = r.where("_p IS NOT NULL").join(left, ends[0]).join(right, ends[1]).select("s", F.col("_p").alias("p"), "o")
    po = [("type", F.col(kind)), ("left", F.col(ends[0]).cast("string")), ("right", F.col(ends[1]).cast("string")), ("confidence", F.lit("0.00")), ("strength", F.col(strength).cast("string"))]
    node = F.concat(F.lit("assertion/"), F.col(relation).cast("string")).alias("s")
    made = r.where("_p IS NULL").select(node, F.inline(F.array(*[F.struct(F.lit(p).alias("p"), o.alias("o")) for p, o in po]))).where("o IS NOT NULL")
    return plain.unionByName(made)


def frames_json(documents: DataFrame, frames: DataFrame, doc: str, frame: str) -> DataFrame:
    """(doc, frames): the frames of each document as a JSON list, [] for documents without."""
    each = frames.groupBy(doc).agg(F.to_json(F.sort_array(F.collect_list(frame))).alias("frames"))
    return documents.select(doc).join(each, doc, "left").withColumn("frames", F.coalesce("frames", F.lit("[]")))


def upload(df: DataFrame, send, batch: int = 100) -> None:
    """Rows sent to a service in batches from the executors; ``send`` gets a list of dicts and must be idempotent, as tasks may run again."""

    def run(rows):
        part = []
        for row in rows:
            part.append(row.asDict(recursive=True))
            if len(part) == batch:
                send(part)
                part = []
        if part:
            send(part)

    df.foreachPartition(run)


def write_dump(tables: dict[str, DataFrame], path: str, form: str = "json") -> None:
    """Each table of a knowledge base in a folder of its name, as JSON lines or Parquet."""
    for name, df in tables.items():
        df.write.mode("overwrite").format(form).save(f"{path}/{name}")


def training_json(tokens: DataFrame, mentions: DataFrame, sentence: list[str], position: str, word: str, mention: str) -> DataFrame:
    """(sentence, example): tokens in order and the mentions on them as one JSON object; sentences without mentions have an empty list."""
    t = tokens.groupBy(*sentence).agg(F.transform(F.array_sort(F.collect_list(F.struct(position, word))), lambda x: x[word]).alias("tokens"))
    m = mentions.groupBy(*sentence).agg(F.sort_array(F.collect_list(mention)).alias("mentions"))
    empty = F.array().cast(m.schema["mentions"].dataType)
    body = F.struct("tokens", F.coalesce("mentions", empty).alias("mentions"))
    return t.join(m, sentence, "left").select(*sentence, F.to_json(body).alias("example"))

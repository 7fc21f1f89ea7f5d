"""Filter interaction audit over failing-id relations.

One id table per filter holds the documents that fail it.  The audit walks the
prefixes of all filter orders, set by set: six relations (all documents, and
the documents failing each filter) are kept under every set of filters applied
before.  A left-anti join with the next filter's id table gives what survives
it, a left-semi join what it has taken away.  Under a set S,

* the survivors among all documents are what S keeps,
* the survivors among the documents failing f are what f removes after S,
* those of them that S has taken are redundant for f.

Sets are built in one order only (ascending filters), so each comes up once;
orders with the same set before a step share its counts.
"""

from __future__ import annotations

import json
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import scratch, store

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#$%&*|]"

#: Failure conditions on the columns ``words`` and ``body`` (the text, null as empty); E is table-wide.
LETTERS = "ABCDE"


def _row_filters() -> dict[str, Column]:
    body, n, distinct = F.col("body"), F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.length(F.regexp_replace(body, "[^A-Z]+", ""))
    return {"A": n < 200, "B": 100 * distinct < 50 * n, "C": 100 * capitals > 3 * F.length(body), "D": body.rlike(SYMBOLS)}


def failing_ids(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The audited documents and the failing-id tables, both stored.

    Documents: ``key`` (128-bit hash of id, language and text), ``part``, ``n``
    (rows with that key), ``good`` and ``toxic`` (those of them labelled so).
    Failing ids: ``filter`` (the filter's bit: 1 for A, 2 for B, ...) and
    ``key``; each filter's table lies in a folder of its own.
    """
    body = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), body.alias("body"), F.regexp_extract_all(body, F.lit(WORD), 0).alias("words"))
    whole = F.unhex(F.sha2(F.col("body").cast("binary"), 256))
    rows = rows.select("doc_id", "part", whole.alias("whole"), *[c.alias(f"fails_{x}") for x, c in _row_filters().items()])
    key = F.unhex(F.md5(F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.hex("whole"), "part").cast("binary")))
    rows = store(rows.withColumn("key", key), "audit-rows")
    # Texts of several documents are few rows: one per text, whatever the number of its copies.
    first = rows.groupBy("whole").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("whole", "first")
    first = store(first, "audit-first")
    copies = rows.select("key", "doc_id", "whole").join(first, "whole").where("doc_id > first").select(F.lit(1 << 4).alias("filter"), "key")
    bits = F.array(*[F.when(F.col(f"fails_{x}"), F.lit(1 << i)) for i, x in enumerate(LETTERS[:4])])
    failed = rows.select(F.explode(F.array_compact(bits)).alias("filter"), "key")
    spark = docs.sparkSession
    path = scratch(spark, "audit-failing")
    failed.unionByName(copies).distinct().write.partitionBy("filter").parquet(path)
    fails = spark.read.schema("key binary, filter int").parquet(path)
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    # Rows of one key are alike in every column, so any of them stands for all; a hot id is counted before the join.
    each = rows.groupBy("key", "doc_id", "part").agg(F.count("*").alias("n"))
    none = F.lit(0)
    documents = each.join(marks, "doc_id", "left").select("key", "part", "n", *[(F.coalesce(c, none) * F.col("n")).alias(c) for c in ("good", "toxic")])
    return store(documents, "audit-documents"), fails


def _counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("part", "relation", "prefix").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def prefix_counts(documents: DataFrame, fails: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Survivors and removed rows of every relation under every set of filters.

    Both have ``part, relation`` (0: all documents; else the bit of the filter
    they fail), ``prefix`` (the bits of the filters applied) and the counts
    ``n, good, toxic``.
    """
    bits = [1 << i for i in range(size)]
    names = [*documents.columns, "relation"]
    everything = documents.withColumn("relation", F.lit(0))
    failing = documents.join(fails, "key").select(*documents.columns, F.col("filter").alias("relation"))
    rows = store(everything.unionByName(failing).withColumn("prefix", F.lit(0)), "audit-prefix-0")
    survivors, taken = [_counts(rows)], []
    for step in range(size):
        # A set grows by filters above its own; a relation is never held against its own filter.
        later = F.filter(F.array(*map(F.lit, bits)), lambda g: (g > F.col("prefix")) & (g != F.col("relation")))
        tried = rows.withColumn("filter", F.explode(later))
        grown = F.col("prefix").bitwiseOR(F.col("filter")).alias("prefix")
        rows = store(tried.join(fails, ["filter", "key"], "left_anti").select(*names, grown), f"audit-prefix-{step + 1}")
        survivors.append(_counts(rows))
        taken.append(_counts(tried.join(fails, ["filter", "key"], "left_semi").select(*names, grown)))
    # What is taken when a set grows by its highest filter stays taken in every larger set built on it.
    larger = {s: [s | above for above in range(0, 1 << size, 1 << s.bit_length())] for s in range(1, 1 << size)}
    known = F.create_map(*[x for s, sets in larger.items() for x in (F.lit(s), F.array(*map(F.lit, sets)))])
    spread = reduce(DataFrame.unionByName, taken).withColumn("prefix", F.explode(F.element_at(known, F.col("prefix"))))
    spread = spread.where(F.col("prefix").bitwiseAND(F.col("relation")) == 0)
    return store(reduce(DataFrame.unionByName, survivors), "audit-survivors"), store(_counts(spread), "audit-taken")


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """How five filters interact in all 120 orders, per language.

    Filters on whole texts (null: empty; words are runs without ASCII white
    space): A under 200 words; B under half of the words distinct; C over 3 %
    capitals A-Z; D one of ``#$%&*|``; E the text of a smaller id, anywhere in
    the table.  Returns ``part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley``.

    A null language is the part ''.  Repeated rows are counted each; rows that
    share an id are documents of their own, none a copy of the other.  A row
    without id copies nothing, is copied by nothing and has no label.  A
    document with several labels is good (toxic) if one of them says so.
    Other columns are ignored; an empty table gives an empty result.
    """
    size = len(LETTERS)
    documents, fails = failing_ids(docs, labels)
    survivors, taken = prefix_counts(documents, fails, size)
    steps = []
    for order in permutations(range(size)):
        before = 0
        for at, i in enumerate(order, 1):
            steps.append({"o": "".join(LETTERS[x] for x in order), "s": at, "f": 1 << i, "b": before})
            before |= 1 << i
    plan = F.from_json(F.lit(json.dumps(steps)), "array<struct<o string, s int, f int, b int>>")
    grid = documents.select("part").distinct().select("part", F.explode(plan).alias("x"))
    grid = grid.select("part", F.col("x.o").alias("filter_order"), F.col("x.s").alias("step"), F.col("x.f").alias("f"), F.col("x.b").alias("before"))
    grid = grid.withColumns({"after": F.col("before").bitwiseOR(F.col("f")), "others": F.lit((1 << size) - 1) - F.col("f")})
    named = lambda df, relation, prefix, **cols: df.select(F.col("part"), F.col("relation").alias(relation), F.col("prefix").alias(prefix), *[F.col(c).alias(a) for a, c in cols.items()])
    out = grid.join(named(survivors.where("relation = 0"), "all", "after", kept="n").drop("all"), ["part", "after"], "left")
    out = out.join(named(survivors, "f", "before", removed="n", good_lost="good", toxic_lost="toxic"), ["part", "f", "before"], "left")
    out = out.join(named(taken, "f", "before", redundant="n"), ["part", "f", "before"], "left")
    out = out.join(named(survivors, "f", "others", unique_fails="n"), ["part", "f", "others"], "left")
    out = out.fillna(0, ["kept", "removed", "good_lost", "toxic_lost", "redundant", "unique_fails"])
    total = out.groupBy("part", "f").agg(F.sum("removed").alias("shapley"))
    out = out.join(total, ["part", "f"])
    return out.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

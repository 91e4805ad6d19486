"""Messages are compacted exactly, with or without anything to remove, and
serialised once however often the compaction looks at them."""

import re

from pyspark.sql import functions as F

from boardwalk.functions import compact_json
from boardwalk.plans.board_plan import messages
from conftest import SF_SMALL, rows

TEXTS = [None, "", "\t", "\r\n \t", "\t{ \n}\r", "{}", " \t {a b}\t \r", "\t\t", "a\tb", "x\r", "\rx", "\n\tx", "x\t ", "{ é 火}", "a b\tc\n", "\r\t{}\t\r"]


def _compacted(x):
    return x if x is None else x.replace("\n", "").replace(" ", "").strip("\t\r")


def test_compaction_is_exact(spark):
    df = spark.createDataFrame([(x,) for x in TEXTS], "t string")
    assert [r.c for r in df.select(compact_json("t").alias("c")).collect()] == [_compacted(x) for x in TEXTS]
    struct = df.select(F.struct("t").alias("s"))
    both = struct.select(compact_json(F.to_json("s")).alias("c"), F.to_json("s").alias("j")).collect()
    assert all(r.c == _compacted(r.j) for r in both)


def test_texts_with_nothing_to_remove_are_not_rewritten(spark):
    """The rewriting stands in a branch of its own."""
    plan = spark.range(1).select(compact_json(F.col("id").cast("string")).alias("c"))._jdf.queryExecution().analyzed().toString()
    assert re.search(r"CASE WHEN .*[Cc]ontains\(.* THEN .*trim\(.*replace\(.* ELSE cast\(id", plan, re.S)


def test_messages_are_still_compact(spark):
    kept = rows(messages(spark, SF_SMALL).select("value").where("value IS NULL OR value RLIKE '[ \\n]' OR value RLIKE '^[\\t\\r]'"))
    assert kept == []

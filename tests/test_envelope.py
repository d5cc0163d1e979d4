import json
import random

import pytest
from pyspark.sql import functions as F

from tillroll.functions import envelope as env
from tillroll.operators.records import decode_feed
from tillroll.schemas import Feed
from tillroll.sinks.log import as_log

ANY = Feed("any", "any.json.gz", "any", 0, "a string")


def values(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def log_of(spark, texts):
    return as_log(
        values(spark, texts).select(
            F.lit("t").alias("topic"),
            F.lit("any").cast("binary").alias("key"),
            F.col("value").cast("binary").alias("value"),
            F.lit(0).alias("partition"),
        )
    )


# record, what the lenient decoder makes of it, what the strict one does
CASES = [
    ('{"a":"plain"}', "plain", "plain"),
    ('{"a":"say \\"hi\\""}', None, 'say "hi"'),
    ('{"a":"café"}', "café", "café"),
    ('{"a":"l1\\nl2"}', "l1\\nl2", "l1\nl2"),
    ('{"a":"c:\\\\x"}', "c:\\\\x", "c:\\x"),
    ("", None, None),
    ("not json", None, None),
]


@pytest.mark.parametrize("record,lenient,strict", CASES)
def test_hand_worked_records(spark, record, lenient, strict):
    # The producer's encoder is Python's: non-ASCII text arrives as escapes.
    log = log_of(spark, [json.dumps(record)])
    assert [r.a for r in decode_feed(log, ANY, envelope="regex").collect()] == [lenient]
    assert [r.a for r in decode_feed(log, ANY).collect()] == [strict]


def test_malformed_records_keep_their_text(spark):
    log = log_of(spark, [json.dumps("not json"), '"cut off', json.dumps('{"a":"x"}')])
    rows = {r._corrupt: r.a for r in decode_feed(log, ANY).collect()}
    assert rows == {"not json": None, '"cut off': None, None: "x"}


def test_round_trip_of_awkward_text(spark):
    rng = random.Random(7)
    alphabet = list('ab "\\/{}[],:\n\r\t\b\f\x00\x1f') + ["é", "日", "😀", "\u2028", "\x85", "'"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(500)]
    texts += ["null", "[]", "[null]", '"']
    frame = values(spark, texts).withColumn("e", env.encode(F.col("value")))
    rows = frame.withColumn("d", env.decode(F.col("e"))).collect()
    assert [r.d for r in rows] == texts
    assert [json.loads(r.e) for r in rows] == texts


def test_decodes_what_another_encoder_wrote(spark):
    texts = ['{"a":"é \\" \\\\ 😀"}', "tab\t", "\u2028"]
    rows = values(spark, [json.dumps(t) for t in texts]).select(env.decode(F.col("value")))
    assert [r[0] for r in rows.collect()] == texts


def test_null_stays_null(spark):
    frame = values(spark, ["x"]).select(F.lit(None).cast("string").alias("value"))
    both = frame.select(env.encode(F.col("value")), env.decode(F.col("value"))).first()
    assert tuple(both) == (None, None)


def test_quotes_around_a_line_are_stripped(spark):
    lines = ['"{"a":1}"', '""x""', 'in"side', '"', ""]
    got = values(spark, lines).select(env.strip_quotes(F.col("value"))).collect()
    assert [r[0] for r in got] == [t.strip('"') for t in lines]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        env.decode(F.col("value"), "xml")

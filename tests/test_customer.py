import pytest
from pyspark.sql import functions as F

from tillroll.functions.scalar import masked, month_name, number, slice_hour
from tillroll.operators.customer import erase_customers, known_customers, latest_customers

FIELDS = "id string, email string, phone_number string, last_change string"


def people(spark, *rows):
    return spark.createDataFrame(rows, FIELDS)


def requests(spark, *ids):
    return spark.createDataFrame([(i, None) for i in ids], "customer_id string, email string")


SHA_ABC = "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"


@pytest.mark.parametrize(
    "text,method,salt,want",
    [
        ("a@b.c", "murmur3", None, "-1494824167"),
        (None, "murmur3", None, "42"),
        ("abc", "sha2", None, SHA_ABC),
        ("bc", "sha2", "a", SHA_ABC),
        (None, "sha2", "a", None),
        ("abc", "null", None, None),
    ],
)
def test_masks(spark, text, method, salt, want):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(masked(F.col("t"), method, salt)).first()[0] == want


def test_unknown_mask():
    with pytest.raises(ValueError):
        masked(F.lit("x"), "rot13")


def test_every_request_counts_and_others_are_untouched(spark):
    rows = [
        ("1", "a@x", "07", "2"),
        ("2", "abc", None, "2"),
        ("3", "abc", "abc", "2"),
        ("3", "abc", "abc", "3"),
        ("0", "z@x", "00", "1"),
        (None, "n@x", "11", "1"),
    ]
    erased = erase_customers(people(spark, *rows), requests(spark, None, "3", "2", "3", "99"))
    assert sorted(map(tuple, erased.collect()), key=str) == sorted(
        [
            ("1", "a@x", "07", "2"),
            ("2", SHA_ABC, None, "2"),
            ("3", SHA_ABC, SHA_ABC, "2"),
            ("3", SHA_ABC, SHA_ABC, "3"),
            ("0", "z@x", "00", "1"),
            (None, "n@x", "11", "1"),
        ],
        key=str,
    )


def test_no_requests_change_nothing(spark):
    frame = people(spark, ("0", "a", "b", "1"), ("00", "a", "b", "1"))
    assert erase_customers(frame, requests(spark)).exceptAll(frame).count() == 0


def test_chosen_columns(spark):
    frame = people(spark, ("1", "abc", "abc", "1"))
    row = erase_customers(frame, requests(spark, "1"), columns=["phone_number"]).first()
    assert (row.email, row.phone_number) == ("abc", SHA_ABC)


def test_null_ids_drop_out(spark):
    frame = people(spark, (None, "a", "b", "1"), ("", "a", "b", "1"))
    assert [r.id for r in known_customers(frame).collect()] == [""]


def test_latest_is_the_last_change_and_settles_ties(spark):
    frame = people(
        spark,
        ("1", "old", "0", "2020-01-01"),
        ("1", "new", "0", "2020-01-02"),
        ("1", "none", "0", None),
        ("2", "a", "0", "2020-01-01"),
        ("2", "b", None, "2020-01-01"),
    )
    for parts in (1, 5):
        got = latest_customers(frame.repartition(parts)).orderBy("id").collect()
        assert [(r.id, r.email) for r in got] == [("1", "new"), ("2", "b")]
    assert latest_customers(frame, keep="any").count() == 2


def test_equal_changes_fall_to_the_last_landed(spark):
    frame = people(spark, ("1", "zzz", "0", "2020-01-01"), ("1", "masked", "0", "2020-01-01"))
    landed = frame.withColumns(
        {
            "date": F.lit("2020-01-01"),
            "hour": F.when(F.col("email") == "zzz", "09").otherwise("10"),
        }
    )
    assert latest_customers(landed).first().email == "masked"


def test_casts_and_labels(spark):
    row = spark.range(1).select(
        number(F.lit("abc"), "float"),
        number(F.lit("1.5")),
        month_name(F.lit("2020-01-01")),
        slice_hour(F.lit("2020-01-01 09:59:59").cast("timestamp")),
        slice_hour(F.lit("2020-01-01 09:59:59").cast("timestamp"), "00"),
    )
    assert tuple(row.first()) == (None, 1.5, "January", "09", "00")

import json

import pytest
from corpus import RECORD, envelope, text
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.operators.decode import DAMAGED, decode, decode_fields
from parcelflow.operators.encode import assemble, encode
from parcelflow.schema import LISTING, SUMMARY_FIELDS

FLAT = [
    "address.city AS city", "property_details.type AS type", "financials.price AS price",
    "financials.price_per_sqft AS unit", "timestamp AS time",
]


def decoded(spark, *values, **options):
    rows = decode(envelope(spark, values), keep=[F.col("offset")], **options)
    return [row.asDict(recursive=True) for row in rows.orderBy("offset").collect()]


def test_whole_message(spark):
    (row,) = decoded(spark, text())
    row.pop("offset")
    assert row == RECORD


@pytest.mark.parametrize("value", [None, "", "not json", "[1, 2]", text()[:300]])
def test_unreadable_values_become_null_rows(spark, value):
    (row,) = decoded(spark, value)
    row.pop("offset")
    assert set(row) == set(RECORD)
    assert all(part is None for part in row.values())


@pytest.mark.parametrize(
    "path, given, kept",
    [
        ("property_details__bedrooms", 1.5, None),
        ("property_details__bedrooms", "7", None),
        ("property_details__has_garage", "true", None),
        ("address__zip_code", 75012, "75012"),
        ("address__street", ["a", "b"], '["a","b"]'),
        ("property_details__lot_size", 6000, 6000.0),
        ("financials__price", 500, 500.0),
    ],
)
def test_mistyped_field_stays_alone(spark, path, given, kept):
    (row,) = decoded(spark, text(**{path: given}))
    outer, inner = path.split("__")
    assert row[outer][inner] == kept
    siblings = {k: v for k, v in row[outer].items() if k != inner}
    assert siblings == {k: v for k, v in RECORD[outer].items() if k != inner}
    assert row["agent"] == RECORD["agent"]


def test_unknown_fields_are_ignored(spark):
    (row,) = decoded(spark, text(extra={"a": 1}))
    row.pop("offset")
    assert row == RECORD


def test_damaged_column(spark):
    values = [text(), None, "", "not json", "[1]", text(property_details__bedrooms="x"), text()[:9]]
    rows = decoded(spark, *values, damaged_column=DAMAGED)
    assert [row[DAMAGED] for row in rows] == [None, None, None, *values[3:]]


def test_no_row_is_dropped(spark):
    values = [text(), None, "", "x", "{", "[]", "{}"]
    assert len(decoded(spark, *values)) == len(values)


def damaged_texts():
    whole = text()
    yield from (whole[:i] for i in range(len(whole) + 1))
    yield from (whole[:i] + whole[i + 1:] for i in range(len(whole)))
    for i in range(len(whole)):
        yield from (whole[:i] + c + whole[i + 1:] for c in '}{",:[]x1 ')
    yield from (None, "", "[1]", "{}", "null", "{" + whole, whole + "}")
    yield from (f"[{whole}]", f"[{whole},{whole}]", whole + whole, f" {whole} x", "\ufeff" + whole)
    odd_values = (5, 1.5, -0.0, 1e308, 10**30, "x", "\t\u0000é", "", True, None, [], {}, [1], {"a": [1]})
    for outer, part in RECORD.items():
        for odd in odd_values:
            yield text(**{outer: odd})
            for inner in part if isinstance(part, dict) else ():
                yield text(**{f"{outer}__{inner}": odd})
    for raw in ("NaN", "Infinity", "-INF", "1e999", "01", "'x'", "/*c*/1", '"\t"', '"\\q"', "[1,]"):
        for old in ('"price":566280.0', '"type":"House"', '"bedrooms":3', '"id":"AGT-00007"',
                    '"walk_score":50', '"latitude":1.5'):
            yield whole.replace(old, f"{old.split(':')[0]}:{raw}")
    for name in ("address", "agent", "financials"):
        yield whole.replace("{", '{"%s":{"city":"Twice","price":1},' % name, 1)
        yield whole.replace("{", '{"extra":{"%s":[{"b":[]}]},' % name, 1)


def test_pruned_decode_equals_whole_decode_on_any_damage(spark):
    """Every cut, deletion and many replacements of a character."""
    rows = envelope(spark, damaged_texts()).repartition(8).cache()
    keep = [F.col("offset")]
    whole = decode(rows, keep=keep).selectExpr("offset", *FLAT)
    pruned = decode_fields(rows, keep=keep).selectExpr("offset", *FLAT)
    assert rows.count() > 10_000
    assert whole.exceptAll(pruned).count() == 0
    assert pruned.exceptAll(whole).count() == 0
    # The damage must bite, or the comparison shows nothing.
    assert whole.filter("city IS NOT NULL AND price IS NULL").count() > 100
    rows.unpersist()


def test_pruned_decode_builds_only_the_named_fields(spark):
    rows = decode_fields(envelope(spark, [text()]))
    assert rows.columns == ["address", "property_details", "financials", "timestamp"]
    assert rows.schema["address"].dataType.names == ["city"]
    assert SUMMARY_FIELDS[0] == "address.city"


def test_pruned_decode_carries_no_text_of_sound_messages(spark):
    """A message's text is read by its first parse alone; of a damaged one the marker holds it."""
    rows = decode_fields(envelope(spark, [text(), text()[:300], None, ""]), keep=[F.col("offset")])
    assert rows._jdf.queryExecution().analyzed().toString().count("cast(value") == 1
    cities = [row.city for row in rows.orderBy("offset").select("address.city").collect()]
    assert cities == ["Dallas", None, None, None]


def strategy(kind):
    if isinstance(kind, T.StructType):
        return st.fixed_dictionaries({f.name: strategy(f.dataType) for f in kind})
    if isinstance(kind, T.ArrayType):
        return st.none() | st.lists(st.none() | letters(), max_size=4)
    if isinstance(kind, T.IntegerType):
        return st.none() | st.integers(-(2**31), 2**31 - 1)
    if isinstance(kind, T.DoubleType):
        return st.none() | st.floats(allow_nan=False, allow_infinity=False)
    if isinstance(kind, T.BooleanType):
        return st.none() | st.booleans()
    return st.none() | letters()


def letters():
    return st.text(st.characters(exclude_categories=["Cs"]), max_size=8)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.data())
def test_decode_undoes_encode(spark, data):
    schema = T.StructType.fromDDL(LISTING)
    records = data.draw(st.lists(strategy(schema), min_size=20, max_size=20))
    numbered = T.StructType([*schema, T.StructField("n", T.IntegerType())])
    rows = [dict(record, n=n) for n, record in enumerate(records)]
    nested = spark.createDataFrame(rows, numbered)
    sent = encode(nested, F.col("n"), "t", schema.names, keep=(F.col("n"),))
    back = decode(sent, keep=[F.col("n")]).orderBy("n").collect()
    assert [row.asDict(recursive=True) for row in back] == rows


def test_messages_write_nulls_and_keys(spark):
    nested = decode(envelope(spark, [text()]))
    sent = encode(nested, F.col("address.city"), "listings", partition=F.lit(3)).collect()[0]
    assert bytes(sent.key) == b"Dallas" and sent.topic == "listings" and sent.partition == 3
    assert json.loads(bytes(sent.value)) == RECORD


def test_assemble_takes_flat_columns_by_name_or_mapping(spark):
    schema = "a STRING, s STRUCT<b: INT, c: STRING>"
    flat = spark.createDataFrame([("x", 1, "y")], "a STRING, b INT, other STRING")
    row = assemble(flat, {"s.c": "other"}, schema=schema).collect()[0]
    assert row.asDict(recursive=True) == {"a": "x", "s": {"b": 1, "c": "y"}}

"""One pass over a message finds what a pass per message shape finds, sound message or not."""

import json

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from oreflow.operators import parse
from oreflow.schemas import FAULTY, TRADE_FIELDS, message_schemas

names = st.sampled_from([*TRADE_FIELDS, "payload", "after", "schema", FAULTY])
scalars = st.one_of(
    st.none(),
    st.booleans(),
    st.integers(-(10**20), 10**20),
    st.floats(),
    st.sampled_from(["", "A", "1.5", "2024-01-01", "NaN", "null", '"', "\\", "\u0000"]),
)
values = st.recursive(
    scalars, lambda inner: st.lists(inner, max_size=3) | st.dictionaries(names, inner, max_size=6), max_leaves=12
)
trades = st.fixed_dictionaries(
    {name: st.sampled_from(["a", 1, 1.5]) for name in TRADE_FIELDS}, optional={"payload": values, "after": values}
)
documents = st.one_of(
    values,
    trades,
    st.builds(lambda payload, rest: {"payload": payload, **rest}, trades, st.dictionaries(names, values, max_size=2)),
    st.builds(lambda trade, payload: trade | {"payload": payload}, trades, trades),
)


def spoil(text, cut, tail):
    return text[: int(len(text) * cut)] + tail


messages = st.one_of(
    documents.map(json.dumps),
    st.builds(spoil, documents.map(json.dumps), st.floats(0, 1), st.sampled_from(["", "}", "x", ' {"a":1}'])),
    st.builds(
        lambda name, value, text: f'{{"{name}":{json.dumps(value)},{text[1:]}', names, scalars, trades.map(json.dumps)
    ),
)


def per_shape(rows):
    flat, envelope, _ = message_schemas()
    both = rows.select("n", F.from_json("value", flat).alias("f"), F.from_json("value", envelope).alias("e"))
    return both.select("n", *(F.coalesce(f"f.{name}", f"e.payload.{name}").alias(name) for name in TRADE_FIELDS))


@settings(
    max_examples=4,
    derandomize=True,
    deadline=None,
    suppress_health_check=[
        HealthCheck.function_scoped_fixture,
        HealthCheck.large_base_example,
        HealthCheck.data_too_large,
        HealthCheck.too_slow,
    ],
)
@given(st.lists(messages, min_size=20, max_size=200))
def test_any_text_reads_the_same(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, value string")
    ours = parse(rows, keep=["n"]).select("n", *TRADE_FIELDS)
    theirs = per_shape(rows)
    assert [str(r) for r in ours.orderBy("n").collect()] == [str(r) for r in theirs.orderBy("n").collect()]


def test_a_message_cut_off_in_its_payload_is_not_a_trade(spark):
    trade = {name: 1 if kind == "double" else "a" for name, kind in TRADE_FIELDS.items()}
    whole = json.dumps(trade | {"payload": {"trade_id": "b"}})
    rows = spark.createDataFrame([(0, whole), (1, whole[:-2]), (2, whole[:-5])], "n int, value string")
    found = {r.n: r.trade_id for r in parse(rows, keep=["n"]).collect()}
    assert found == {0: "a", 1: None, 2: None}

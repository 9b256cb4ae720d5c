"""Column functions against plain Python, over values made by rule."""

import hashlib
import json
import random
from datetime import UTC, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from packetflow import functions as fn
from packetflow.functions.text import WHITESPACE

CLASS_OF = {**{p: p for p in fn.PROTOCOLS}, "TLS": "HTTPS", "SSL": "HTTPS"}


def apply(spark, column, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = df.select("i", column(F.col("v")).alias("out")).orderBy("i").collect()
    return [r["out"] for r in rows]


def padded(rng, text):
    ends = ["".join(rng.choices(WHITESPACE, k=rng.randrange(3))) for _ in range(2)]
    return ends[0] + text + ends[1]


def any_case(rng, text):
    return "".join(rng.choice([c.lower(), c.upper()]) for c in text)


def test_protocol_classes(spark):
    rng = random.Random(1)
    names = [padded(rng, any_case(rng, rng.choice(list(CLASS_OF)))) for _ in range(200)]
    others = [rng.choice(["", name[:-1], name + "x", name[0] + " " + name[1:]]) for name in CLASS_OF for _ in range(4)]
    got = apply(spark, fn.classify_protocol, [*names, *others, None])
    assert got[:200] == [CLASS_OF[n.strip(WHITESPACE).upper()] for n in names]
    assert got[200:] == [CLASS_OF.get(n.upper(), "OTHER") for n in others] + ["OTHER"]


def test_blank_and_trimmed_text(spark):
    rng = random.Random(2)
    words = [padded(rng, rng.choice(["", "a", "a b", "a　b"])) for _ in range(200)]
    assert apply(spark, fn.trimmed, words) == [w.strip(WHITESPACE) for w in words]
    assert apply(spark, fn.is_blank, [*words, None]) == [not w.strip(WHITESPACE) for w in words] + [True]


def test_key_hash_includes_the_newline(spark):
    keys = [f"key {i}" * i for i in range(5)]
    assert apply(spark, fn.api_key_hash, [*keys, None]) == [
        hashlib.sha256(k.encode() + b"\n").hexdigest() for k in keys
    ] + [None]


def test_stable_ids_differ_for_different_places(spark):
    parts = [None, "", "a", "|", "\\", "\\N", "a|", "|a", "\\|"]
    rows = [(a, b, c) for a in parts for b in parts for c in parts]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    ids = df.select(fn.stable_id("a" and F.col("a"), F.col("b"), F.col("c")).alias("id"))
    assert ids.distinct().count() == len(rows)
    one = df.filter("a = 'a' AND b = '' AND c = 'a'").select(fn.stable_id(F.col("a"), F.col("c")).alias("id"))
    assert one.first()["id"] == hashlib.sha256(b"a|a").hexdigest()


def test_lines_of_a_payload(spark):
    rng = random.Random(3)
    values = ["\n".join(padded(rng, rng.choice(["", "x", "y z"])) for _ in range(rng.randrange(1, 5))) for _ in range(100)]
    want = [[line.strip(WHITESPACE) for line in v.split("\n") if line.strip(WHITESPACE)] for v in values]
    assert apply(spark, fn.split_lines, [*values, None]) == [*want, None]


def json_value(rng, depth=0):
    kinds = [lambda: rng.randrange(100), lambda: rng.choice(["s", "]", "}", "{", '"']), lambda: None, lambda: True]
    if depth < 2:
        kinds += [
            lambda: [json_value(rng, depth + 1) for _ in range(rng.randrange(3))],
            lambda: {k: json_value(rng, depth + 1) for k in rng.sample("abcd", rng.randrange(4))},
        ] * 2
    return rng.choice(kinds)()


def test_one_whole_object(spark):
    rng = random.Random(4)
    values = [json_value(rng) for _ in range(150)]
    texts = [padded(rng, json.dumps(v)).replace("\x85", "\n").translate({ord(c): " " for c in WHITESPACE if ord(c) > 127 or c in "\x0b\x0c"}) for v in values]
    good = [isinstance(v, dict) for v in values]
    objects = [t for t, ok in zip(texts, good, strict=True) if ok]
    broken = [t.rstrip() + rng.choice(["]", "}", " x", "] x", ",{}", "}] x"]) for t in objects]
    broken += [t.rstrip()[:-1] for t in objects]
    cases = [*zip(texts, good, strict=True), *((t, False) for t in broken), (None, False), ("", False)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, v string")
    for read in (fn.with_record, fn.with_object):
        rows = read(df, F.col("v"), "a string", "rec").orderBy("i").collect()
        assert [(r["v"], r["rec"] is not None) for r in rows] == cases

    def first(v):
        return F.try_element_at(fn.strict_object(v, "a string"), F.lit(1)).isNotNull()

    assert apply(spark, first, [t for t, _ in cases]) == [ok for _, ok in cases]


def test_last_of_equal_keys_counts(spark):
    df = spark.createDataFrame([("{" + ",".join(f'"a":{i}' for i in range(n)) + "}",) for n in (1, 2, 5)], "v string")
    rows = fn.with_record(df, F.col("v"), "a string", "rec").collect()
    assert [r["rec"]["a"] for r in rows] == ["0", "1", "4"]


def spelled(rng, at):
    """An instant in a random accepted form, and the instant that form stands for."""
    form = rng.randrange(4)
    if form == 0:
        return json.dumps(int(at.timestamp() * 1000)), at
    if form == 1:
        return json.dumps(at.strftime("%Y-%m-%d")), at.replace(hour=0, minute=0, second=0)
    text = at.strftime(f"%Y-%m-%d{rng.choice('T ')}%H:%M:%S")
    if form == 2:
        return json.dumps(text + rng.choice(["", "Z"])), at
    hours = rng.randrange(-11, 12)
    return json.dumps(text + f"{hours:+03d}:30"), at.replace(tzinfo=timezone(_offset(hours)))


def _offset(hours):
    return timedelta(hours=hours, minutes=30 if hours >= 0 else -30)


def test_stored_times(spark):
    rng = random.Random(5)
    cases = []
    for _ in range(150):
        at = datetime(1990, 1, 1, tzinfo=UTC) + timedelta(seconds=rng.randrange(10**9))
        text, means = spelled(rng, at)
        cases.append((text, int(means.timestamp())))
        short = json.dumps(at.strftime(rng.choice(["%Y", "%H:%M", "%d %b %Y", "on %Y-%m-%d"])))
        cases.append((short, None))
    for value in (None, True, 0.5, {}, [], "", str(10**12), 1 << 62, -(1 << 62)):
        cases.append((json.dumps(value), None))
    df = spark.createDataFrame([(i, f'{{"t":{t}}}') for i, (t, _) in enumerate(cases)], "i int, v string")
    field = F.try_variant_get(F.try_parse_json("v"), "$.t", "variant")
    rows = df.select("i", F.unix_seconds(fn.stored_at(field)).alias("s")).orderBy("i").collect()
    assert [(cases[r["i"]][0], r["s"]) for r in rows] == cases


@pytest.mark.parametrize("ms", [0, 1, 255, 256, 1705300000123, (1 << 63) - 1, -1])
def test_message_headers(spark, ms):
    pairs = {f"k{i}": f"v{i}" for i in range(ms % 4)}
    df = spark.createDataFrame([(ms, pairs), (ms, None)], "ms bigint, m map<string,string>")
    full, bare = [r[0] for r in df.select(fn.message_headers(F.col("ms"), F.lit("Kind"), F.col("m"))).collect()]
    assert [h["key"] for h in bare] == ["timestamp", "type"]
    assert int.from_bytes(full[0]["value"], "little", signed=True) == ms
    assert bytes(full[1]["value"]) == b"Kind"
    assert {h["key"]: bytes(h["value"]).decode() for h in full[2:]} == pairs


def test_attempts_are_counted_by_the_last_header(spark):
    rng = random.Random(7)
    rows = []
    for _ in range(100):
        values = [rng.choice(["7", "12", "x", "", "1.5", str(1 << 40)]) for _ in range(rng.randrange(3))]
        own = [("attempts", v) for v in values] + [("other", "3")] * rng.randrange(2)
        if rng.random() < 0.5:
            own.reverse()
        rows.append(own)

    def count(own):
        last = [v for k, v in own if k == "attempts"][-1:]
        return int(last[0]) if last and last[0].isdigit() and int(last[0]) < 1 << 31 else 0

    kind = "array<struct<key:string,value:binary>>"
    headers = [[(k, bytearray(v.encode())) for k, v in own] for own in rows]
    assert apply(spark, fn.attempt_count, [*headers, None], kind) == [*map(count, rows), 0]

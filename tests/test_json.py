"""JSON rules against the hand-made cases of FIXTURES.md section 1."""

import json

import duckdb
import pytest
from pyspark.sql import functions as F

from quayside.functions import bytes_outcome, is_json, json_bigint, json_outcome, json_scalar, with_is_json, with_json_scalar

# (message, expected BIGINT in permissive mode, strict raises)
CASES = [
    ('{"timestamp":1700000000123}', 1700000000123, False),
    ('{"timestamp":"17"}', 17, False),
    ('{"timestamp":" 12 "}', 12, False),
    ('{"timestamp":"12.5"}', None, True),
    ('{"timestamp":"abc"}', None, True),
    ('{"timestamp":{"a":1}}', None, False),
    ('{"timestamp":[1]}', None, False),
    ('{"timestamp":null}', None, False),
    ('{"other":1}', None, False),
    ('[{"timestamp":1}]', None, False),
    ("3", None, False),
    ('{"timestamp":12.5}', None, True),
    ('{"timestamp":true}', None, True),
    ('{"timestamp":1,"timestamp":2}', 2, False),
    ('{"timestamp":1.0}', None, True),
    ('{"timestamp":-0}', 0, False),
    ('{"timestamp":1} trailing', None, False),
    ('{"timestamp":1, bad', None, False),
    ("not json", None, False),
    ("", None, False),
    (None, None, False),
]


@pytest.fixture(scope="module")
def messages(spark):
    return spark.createDataFrame([(i, m) for i, (m, _, _) in enumerate(CASES)], "id int, m string")


def test_permissive_bigint(messages):
    got = {r.id: r.ts for r in messages.select("id", json_bigint("m", "$.timestamp").alias("ts")).collect()}
    assert got == {i: exp for i, (_, exp, _) in enumerate(CASES)}


def test_parse_once_form_equals_column_form(messages):
    a = with_json_scalar(messages, "m", "$.timestamp", "v", "ts", valid_out="ok")
    b = messages.select("id", json_scalar("m", "$.timestamp").alias("v2"), is_json("m").alias("ok2"),
                        json_bigint("m", "$.timestamp").alias("ts2"))
    for r in a.join(b, "id").collect():
        assert (r.v, r.ts, r.ok) == (r.v2, r.ts2, r.ok2), r


@pytest.mark.parametrize("i", [i for i, (_, _, strict) in enumerate(CASES) if strict])
def test_strict_raises(spark, messages, i):
    one = messages.where(F.col("id") == i)
    with pytest.raises(Exception):
        one.select(json_bigint("m", "$.timestamp", mode="strict")).collect()


def test_strict_passes_good_rows(messages):
    good = [i for i, (_, exp, strict) in enumerate(CASES) if not strict]
    rows = messages.where(F.col("id").isin(good)).select(json_bigint("m", "$.timestamp", mode="strict")).collect()
    assert len(rows) == len(good)


def test_object_or_array_at_path_is_null(messages):
    vals = {r.id: r.v for r in messages.select("id", json_scalar("m", "$.timestamp").alias("v")).collect()}
    assert vals[5] is None and vals[6] is None and vals[1] == "17" and vals[3] == "12.5"


def test_texts_beyond_the_parser_are_undecided(spark):
    deep, long_number = "[" * 1200 + "]" * 1200, "1" * 1200
    name = "n" * 60_000
    texts = [deep, "1" * 120_000, '{"a":' + deep + "}", "[" * 500 + "]" * 500, long_number, "[" * 1200, "x" * 3000, "not json", None, '{"%s":1}' % name, '"%s"' % name, name]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, m string")
    want = ["undecided", "undecided", "undecided", "json", "json", "undecided", "not_json", "not_json", None, "undecided", "json", "not_json"]
    got = {r.id: r.o for r in df.select("id", json_outcome("m").alias("o")).collect()}
    assert [got[i] for i in range(len(texts))] == want
    flag = {"json": True, "not_json": False, "undecided": None, None: None}
    once = {r.id: r.ok for r in with_is_json(df, "m", "ok").collect()}
    assert [once[i] for i in range(len(texts))] == [flag[w] for w in want]


def test_validity_matches_python_and_duckdb(spark):
    texts = ['{"a":1}', "3", '"x"', "null", "[1,2]", " {\"a\":1} ", '{"a":1} x', "3 4", "1 /*c*/",
             "", "not json", '{"a":1}]', "1],[2", "{'a':1}", "1e5", "[", "01", '{"k":1,"k":2}', '{"a":{"k":1,"k":[]}}', "1.0", "1e400", "-0", "-", "1.",
             '1,"y":2', '1},{"x":2', "nul", " null ", "nullnull", '"a" "b"', "\u00a0null", '{"a":"b\tc"}', "tru", "[1,]", "{,}", '{"a":1,}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, m string")
    ours = {r.id: r.ok for r in with_is_json(df, "m", "ok").collect()}
    for i, t in enumerate(texts):
        try:
            json.loads(t)
            py = True
        except ValueError:
            py = False
        assert ours[i] == py, t
        if t not in ("[1,]", '{"a":1,}'):  # DuckDB lets a last comma pass
            assert ours[i] == duckdb.execute("select json_valid(?)", [t]).fetchone()[0], t


BS = "\\"
# (message, scalar at $.k): numbers as written, the last of repeated keys, lone surrogates as U+FFFD
EXACT = [
    ('{"k":1.0}', "1.0"), ('{"k":1.10}', "1.10"), ('{"k":1e400}', "1e400"), ('{"k":-0}', "-0"), ('{"k":1E+2}', "1E+2"), ('{"k": 0.10e-07 }', "0.10e-07"),
    ('{"k":123456789012345678901234567890.0}', "123456789012345678901234567890.0"), ('{"k":1,"k":2}', "2"), ('{"k":{"a":1},"k":"x"}', "x"), ('{"k":"x","k":[1]}', None),
    ('{"k":"1.0"}', "1.0"), ('{"k":"{a}"}', "{a}"), ('{"k":"[1]"}', "[1]"), ('{"k":"true"}', "true"), ('{"k":true}', "true"), ('{"k":false}', "false"), ('{"k":null}', None),
    ('{"k":"null"}', "null"), ('{"k":""}', ""), ('{"k":{}}', None), ('{"k":[]}', None), ('{"j":1}', None), ('[{"k":1}]', None), ("1.0", None),
    (f'{{"k":"{BS}{BS}"}}', BS), (f'{{"k":"{BS}""}}', '"'), ('{"k":"""}', None), (f'{{"k":"a{BS}"1.0{BS}"b"}}', 'a"1.0"b'), (f'{{"a{BS}"k":1,"k":2.50}}', "2.50"), (f'{{"k":"{BS}{BS}{BS}"-1"}}', BS + '"-1'),
    (f'{{"{BS}u006b":1.50}}', "1.50"), (f'{{"k":"{BS}u0001x"}}', "\u0001x"), (f'{{"k":"{BS}ud800"}}', "\ufffd"), (f'{{"k":"{BS}uDC00{BS}ud83d{BS}ude00{BS}uD83D"}}', "\ufffd\U0001f600\ufffd"),
    (f'{{"k":"{BS}{BS}ud800"}}', BS + "ud800"), ('{"k":"é😀"}', "é😀"), ('{"x":{"k":1},"k":7}', "7"), ('{"k":"a\\nb"}', "a\nb"), ('{"k":1.0} x', None), ('{"k":NaN}', None), ("", None), (None, None), (f'{{"k":"{BS}u0000null"}}', "\0null"), ('{"k":"{\\u0041"}', "{A"), ('{"k":" [x"}', " [x"), ('{"j":1.5,"k":"7"}', "7"),
]


def test_scalars_keep_their_text(spark):
    df = spark.createDataFrame([(i, m) for i, (m, _) in enumerate(EXACT)], "id int, m string")
    got = {r.id: (r.a, r.b) for r in with_json_scalar(df, "m", "$.k", "a").withColumn("b", json_scalar("m", "$.k")).collect()}
    for i, (m, want) in enumerate(EXACT):
        assert got[i] == (want, want), m


@pytest.mark.parametrize("path,want", [("$", None), ("$.a[1].b", "2.0"), ("$['a'][0]", "x"), ('$["c d"]', "1.50"), ("$.a[9].b", None), ("$.a", None), ("$.a[1]['b']", "2.0"), ("$.e`f", "7"), ("$.a[0].b", None), ("$.d.k", None)])
def test_paths(spark, path, want):
    df = spark.createDataFrame([('{"a":["x",{"b":2.0}],"c d":1.50,"e`f":7,"d":{"k":1},"d":5}',)], "m string")
    assert df.select(json_scalar("m", path).alias("v")).first().v == want


def test_bad_paths():
    for path in ("k", "$k", "$.", "$.a[x]", "$.a b["):
        with pytest.raises(ValueError):
            json_scalar("m", path)


def test_bytes_must_be_utf8(spark):
    good, bad = ["", "é", "😀", '{"k":"é"}', '{"k":1,"k":2}', "3", "\u0000"], [b"\xff", b"\xc3", b"\xc0\x80", b"\xed\xa0\x80", b"\xf4\x90\x80\x80", b'{"k":"\xff"}', b"\x80", b"\xe2\x82"]
    rows = [(t.encode(),) for t in good] + [(b,) for b in bad] + [(None,)]
    out = {None if r.m is None else bytes(r.m): r.o for r in spark.createDataFrame(rows, "m binary").select("m", bytes_outcome("m").alias("o")).collect()}
    for (m,) in rows:
        if m is None:
            assert out[m] is None
            continue
        try:
            json.loads(m.decode())
            want = "json"
        except UnicodeDecodeError:
            want = "not_utf8"
        except ValueError:
            want = "not_json"
        assert out[m] == want, m

import pytest
from pyspark.sql import functions as F

from conftest import JSON_CASES
from snaptally.operators import parse_records, table_stats


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame([(i, c[0]) for i, c in enumerate(JSON_CASES)], "i int, value string")


def test_strict_validity_table_size(cases):
    rows = {r.i: r for r in parse_records(cases).orderBy("i").collect()}
    for i, (line, valid, table, size) in enumerate(JSON_CASES):
        r = rows[i]
        assert r.is_valid is valid, (i, line)
        assert r.tableName == table, (i, line)
        assert (r["~recordSize"] or 0) == size, (i, line)
        assert (r.error is None) == valid
        assert (r.record is None) == (not valid)


def test_error_code(cases):
    bad = parse_records(cases).where(~F.col("is_valid")).select("error").distinct().collect()
    assert [r.error for r in bad] == ["MALFORMED_JSON"]


def test_table_stats_fixture(cases):
    first22 = cases.where(F.col("i") <= 21)
    got = {r.tableName: (r.recordCount, r.tableSize) for r in table_stats(parse_records(first22)).collect()}
    assert got == {"t": (3, 66), "5": (1, 12), '{"x":1}': (1, 18), "": (1, 13), "unknown": (16, 24)}


def test_lenient_mode(cases):
    rows = {r.i: r for r in parse_records(cases, lenient=True).collect()}
    for i in (10, 22, 24):  # single quotes, NaN, bare name
        assert rows[i].is_valid, JSON_CASES[i][0]
    for i in (7, 11, 25, 12, 14, 2, 3, 4, 5, 6, 19, 23, 26, 27, 28, 29):
        assert not rows[i].is_valid, JSON_CASES[i][0]
    assert rows[10].tableName == "t"
    assert rows[0].tableName == "t" and rows[0]["~recordSize"] == 20


def test_units_and_checksum(spark):
    df = spark.createDataFrame([('{"~table":"a\U0001F600é"}',)], "value string")
    r = parse_records(df, checksum=True).first()
    assert r["~recordSize"] == 17
    assert parse_records(df, unit="chars").first()["~recordSize"] == 16
    assert parse_records(df, unit="bytes").first()["~recordSize"] == 20
    import hashlib

    assert r["~checksum"] == hashlib.sha256(df.first().value.encode()).hexdigest()


def test_record_column_is_variant(cases):
    from pyspark.sql.types import VariantType

    out = parse_records(cases)
    assert isinstance(out.schema["record"].dataType, VariantType)
    assert "record" not in parse_records(cases, keep_record=False).columns
    v = out.where("i = 9").select(F.try_variant_get("record", "$['~table'].x", "int").alias("x")).first()
    assert v.x == 1


def test_every_line_one_row(cases):
    assert parse_records(cases).count() == len(JSON_CASES)


def test_extra_strict_cases(spark):
    lines = {
        '{"a":1}/*c*/': False, '{"a":[1,2}': False, '{"a":01}': False, '{"a":1,}': False,
        "[]": False, '{"w":1}]': False, '{"a":"\\u00e9"}': True, '{"a":"\\q"}': False,
        '{"a":{"b":{"c":[1,{"d":null}]}}}': True, '\t{"a":1}\t': True,
    }
    df = spark.createDataFrame([(k,) for k in lines], "value string")
    got = {r.value: r.is_valid for r in parse_records(df).collect()}
    assert got == lines


def large_lines():
    """Records beyond the parser's default limits, good and damaged, with their table."""
    text = "x" * 25_000_000
    deep = '[' * 1200 + ']' * 1200
    key = "k" * 70
    nested = '{"a":' * 1200 + '[1,{}]' + "}" * 1200
    return {
        f'{{"~table":"t1","a":"{text}"}}': "t1",
        f'{{"a":"{text}","~table":"{"n" * 90}"}}': "n" * 90,
        f'{{"a":"{text}"}}': "unknown",
        f'{{"a":"{text}\\q"}}': None,
        f'{{"a":"{text}","b":1,"b":2}}': None,
        f'{{"a":"{text}","b":{{"c":1,"c":2}}}}': None,
        f'{{"a":"{text}"}} x': None,
        f'{{"a":"{text}"}},"b":1': None,
        f'{{"a":"{text}': None,
        f'["{text}"]': None,
        f'{{"~table":"d","a":{deep}}}': "d",
        f'{{"~table":"d","a":{deep[:-1]}}}': None,
        f'{{"~table":"d","a":{deep}}}}}': None,
        # keys are compared whole, however they're escaped and wherever they are
        f'{{"~table":"k","{key}1":1,"{key}2":"{text}"}}': "k",
        f'{{"~table":"k","{key}1":1,"{key}1":"{text}"}}': None,
        f'{{"~table":"k","{key}1":1,"{key}\\u0031":"{text}"}}': None,
        f'{{"~table":{{"x": 1.50}},"a":"{text}"}}': '{"x":1.5}',
        f'{{"~table":"d","a":1,"a":{deep}}}': None,
        f'{{"~table":"d","a":{"[" * 1200}{{"q":1,"q":2}}{"]" * 1200}}}': None,
        f'{{"~table":"d","a":{nested}}}': "d",
        f'{{"~table":"d","a":{nested[:-1]}]}}': None,
        f'{{"~table":"d","a":{nested}}},"b":1': None,
        '{"~table":"w",' + ",".join(f'"c{i}":[{i},{{"a":{i}}}]' for i in range(700_000)) + "}": "w",
    }


def test_no_record_is_bad_for_its_size_or_depth(spark, tmp_path):
    cases = large_lines()
    (tmp_path / "p").write_text("\n".join(cases) + "\n")
    df = spark.read.text(str(tmp_path / "p")).selectExpr("value", "crc32(value) as c", "length(value) as n")
    got = {(r.c, r.n): r for r in parse_records(df, keep_record=False).selectExpr("c", "n", "is_valid", "tableName", "`~recordSize` as size").collect()}
    import zlib

    for line, table in cases.items():
        r = got[(zlib.crc32(line.encode()), len(line))]
        assert (r.is_valid, r.tableName, r.size) == ((True, table, len(line)) if table else (False, "unknown", None)), line[:40] + line[-40:]


def test_kinds_of_bad_large_lines(spark):
    text, deep = "x" * 21_000_000, "[" * 1200 + "]" * 1200
    cases = {
        f'{{"a":"{text}"}}}}': "TRAILING_CONTENT", f'{{"a":"{text}"}} x': "INVALID_JSON", f'[{{"a":"{text}"}}]': "NOT_AN_OBJECT", f'"{text}"': "NOT_AN_OBJECT",
        f'{{"a":"{text}\x01"}}': "INVALID_JSON", f'{{"a":{deep}}},"k":1': "TRAILING_CONTENT", f"[{deep}]": "NOT_AN_OBJECT", f'{{"a":{deep}': "INVALID_JSON", f'{{"a":-7777777,"b":{deep}}}': None,
    }
    for line, kind in cases.items():
        r = parse_records(spark.createDataFrame([(line,)], "value string"), keep_record=False).select("is_valid", "error_kind").first()
        assert tuple(r) == (kind is None, kind), line[:30] + line[-30:]


def test_one_field_of_140_megabytes(spark):
    df = spark.range(1).selectExpr("concat('{\"~table\":\"big\",\"a\":\"', repeat('abcdefghij', 14000000), '\"}') as value")
    r = parse_records(df, keep_record=False).selectExpr("is_valid", "tableName", "`~recordSize` as n").first()
    assert (r.is_valid, r.tableName, r.n) == (True, "big", 140_000_000 + len('{"~table":"big","a":""}'))
    r = parse_records(df, keep_record=False, lenient=True).selectExpr("is_valid", "tableName").first()
    assert tuple(r) == (True, "big")


def test_typed_records_infers_from_good_lines_only(spark, tmp_path):
    from snaptally.operators import typed_records
    from snaptally.sinks import write_parquet

    lines = ['{"~table":"t","a":1,"b":{"c":"x"}}', '{"a":"s"}', "bad", '{"a":1,"a":2}', '{"n":null,"h":[1,2]}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    typed = typed_records(parse_records(df))
    assert sorted(typed.columns) == ["a", "b", "h", "n", "~recordSize", "~table"]
    assert typed.schema["a"].dataType.typeName() == "variant"  # 1 and "s": types differ
    assert typed.schema["n"].dataType.typeName() == "string"   # only nulls seen
    assert typed.count() == 3
    back = spark.read.parquet(write_parquet(typed, str(tmp_path / "t")))
    assert back.where("`~table` = 't'").select("b.c").first()[0] == "x"


def test_variant_schema_to_ddl_keeps_quoted_names():
    from snaptally.functions.json import variant_schema_to_ddl

    got = variant_schema_to_ddl("OBJECT<OBJECT: VOID, `x``OBJECT<y`: OBJECT<VOID: VOID>, a: ARRAY<OBJECT<b: BIGINT>>>")
    assert got == "STRUCT<OBJECT: STRING, `x``OBJECT<y`: STRUCT<VOID: STRING>, a: ARRAY<STRUCT<b: BIGINT>>>"


def test_lenient_mode_has_no_trailing_gap(spark):
    bad = ['{"a":1}]x', '{"a":1}] ', '{"a":1},{"b":2}', '{"a":1}}x', "{'a':1}]", '{"a":1}]}', '{"a":1}x',
           '{"a":1} ]', '{"a":{"b":1}]}', '{"a":1},"b":2', '{"a":1},"b"', '{"a":1}}]', '{"a":1}]}]', '{"a":1}}}']
    good = ["{'a':1}", '{"a":1}', "{a:1}", '{"a":NaN}', '{"a":"x\ty"}']
    bad.append('{"a":1,"a":2}')
    df = spark.createDataFrame([(x,) for x in bad + good], "value string")
    got = {r.value: r.is_valid for r in parse_records(df, lenient=True).collect()}
    assert [x for x in bad if got[x]] == []
    assert [x for x in good if not got[x]] == []


def test_error_kinds(spark):
    cases = {
        "": "EMPTY_LINE", "  ": "EMPTY_LINE", "\t": "EMPTY_LINE",
        "null": "NOT_AN_OBJECT", "[1]": "NOT_AN_OBJECT", '"abc"': "NOT_AN_OBJECT", '[{"a":1}]': "NOT_AN_OBJECT",
        '{"a":1}}': "TRAILING_CONTENT", '{"a":1},"z":1': "TRAILING_CONTENT",
        '{"a":1': "INVALID_JSON", '{"a":1} x': "INVALID_JSON", '{"a":1,"a":2}': "INVALID_JSON",
        '{"a":NaN}': "INVALID_JSON", '{"a":1}]': "INVALID_JSON",
        '{"a":1}': None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "value string")
    got = {r.value: r.error_kind for r in parse_records(df, keep_record=False).collect()}
    assert got == cases


def test_existing_output_columns_are_refused(spark):
    import pytest

    df = spark.createDataFrame([("{}", "x")], "value string, tableName string")
    with pytest.raises(ValueError):
        parse_records(df)


def test_typed_records_needs_variant_records(spark):
    import pytest

    from snaptally.operators import typed_records

    df = spark.createDataFrame([('{"a":1}',)], "value string")
    with pytest.raises(ValueError):
        typed_records(parse_records(df, keep_record=False))
    with pytest.raises(ValueError):
        typed_records(parse_records(df, lenient=True))


def test_typed_records_without_good_lines(spark):
    from snaptally.operators import typed_records

    df = spark.createDataFrame([("bad",), ("",)], "value string")
    assert typed_records(parse_records(df)).count() == 0


def test_typed_records_schema_size_and_empty_objects(spark, tmp_path):
    import pytest

    from snaptally.operators import typed_records
    from snaptally.sinks import write_parquet

    def parsed(*lines):
        return parse_records(spark.createDataFrame([(x,) for x in lines], "value string"))

    # the computed size replaces the input's, empty objects can be written
    typed = typed_records(parsed('{"~recordSize":999,"a":1,"b":{}}', '{"a":2,"c":[{}]}'))
    back = spark.read.parquet(write_parquet(typed, str(tmp_path / "a")))
    assert sorted((r["a"], r["~recordSize"]) for r in back.collect()) == [(1, 32), (2, 16)]
    assert typed_records(parsed("{}")).collect() == [(2,)]
    # a given schema: one pass, values that don't fit are NULL
    typed = typed_records(parsed('{"a":9007199254740993}', '{"a":"x"}'), schema="a bigint, z string")
    assert sorted((r["a"] is None, r["a"], r["z"]) for r in typed.collect()) == [(False, 9007199254740993, None), (True, None, None)]
    # names equal except for case collide at any level
    with pytest.raises(ValueError):
        typed_records(parsed('{"x":{"A":1,"a":2}}'))

from conftest import rows
from rillflow.sources import tables


def written(spark, tmp_path, *lines):
    path = tmp_path / "in"
    path.mkdir()
    (path / "a.json").write_text("\n".join(lines) + "\n")
    return str(path)


def test_broken_and_drifting_lines(spark, tmp_path):
    path = written(
        spark, tmp_path,
        '{"a": 1, "b": "x", "n": null, "VOID": 1, "o": {"p": 1}, "odd name": "VOID OBJECT<"}',
        '{"a": 2.5, "b": 7, "n": null, "l": [1, 2], "o": {"q": "z"}}',
        '{"a": 3, "b"', "", "   ", "[1, 2]", "42", "null", "{}",
    )
    good, broken, n = tables.read_variant_json(spark, path)
    assert n == 4 and rows(broken) == [("42",), ("[1, 2]",), ("null",), ('{"a": 3, "b"',)]
    kinds = {f.name: f.dataType.simpleString() for f in good.schema}
    assert kinds["b"] == "variant" and kinds["n"] == "string" and kinds["VOID"] == "bigint"
    assert kinds["a"].startswith("decimal") and kinds["l"] == "array<bigint>"
    assert kinds["o"] == "struct<p:bigint,q:string>" and kinds["odd name"] == "string"
    found = [tuple(r) for r in good.selectExpr("cast(a as double) a", "cast(b as string) b", "o.p", "o.q", "l[1]", "n", "`odd name`").collect()]
    assert sorted(found, key=str) == sorted(
        [(1.0, "x", 1, None, None, None, "VOID OBJECT<"), (2.5, "7", None, "z", 2, None, None), (None,) * 7], key=str
    )


def test_only_broken_lines_and_none(spark, tmp_path):
    good, broken, n = tables.read_variant_json(spark, written(spark, tmp_path, "x", "{"))
    assert (good.columns, good.count(), n, broken.count()) == ([], 0, 2, 2)
    (tmp_path / "in" / "a.json").write_text("")
    good, broken, n = tables.read_variant_json(spark, str(tmp_path / "in"))
    assert (good.count(), n, broken.count()) == (0, 0, 0)


def test_same_rows_as_the_inferring_reader(spark, tmp_path):
    path = written(spark, tmp_path, *[f'{{"k": "w{i % 3}", "v": {i}, "s": {{"t": "{i}"}}}}' for i in range(50)])
    good, _, n = tables.read_variant_json(spark, path)
    assert n == 0
    assert rows(good.select("k", "v", "s.t")) == rows(spark.read.json(path).select("k", "v", "s.t"))

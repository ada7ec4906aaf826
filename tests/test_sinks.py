import glob
import json

import yaml
from pyspark.sql import functions as F

from slotweave.sinks.flatten import flatten
from slotweave.sinks.spec_files import placed_texts, read_spec_files, write_spec_files
from slotweave.sinks.writers import output_name, write_tsv, write_wrapped_json, yaml_documents


def test_wrapped_json_over_many_parts(spark, tmp_path):
    """The parts make one document even when the first ones hold no row."""
    spark.range(0, 400, 1, 8).selectExpr("id", "concat('\"', id) s").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "100000000")
    try:
        for low in (-1, 0, 260, 1000):
            out = str(tmp_path / f"out{low}")
            rows = stored.filter(F.col("id") > low)
            write_wrapped_json(rows, out, "things")
            text = "".join(open(p).read() for p in sorted(glob.glob(f"{out}/part-*")))
            got = json.loads(text)["things"]
            assert sorted(r["id"] for r in got) == list(range(max(low + 1, 0), 400))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_yaml_of_every_type(spark):
    df = spark.sql("""
      SELECT 1 a, 1.5e20D b, 'x: "y"\\n- z #' c, true d, DATE'2024-01-02' e, CAST(NULL AS STRING) f,
             named_struct('g', CAST(NULL AS STRUCT<h: INT>), 'i', array(named_struct('j', 'k', 'l', named_struct('m', 2)))) n,
             CAST(array() AS ARRAY<STRUCT<z: INT>>) o, array('p', 'q') r, map('s', 1) t, '1' u, 'null' v
    """)
    (text,) = yaml_documents(df).first()
    assert yaml.safe_load(text) == {
        "a": 1, "b": 1.5e20, "c": 'x: "y"\n- z #', "d": True, "e": "2024-01-02", "f": None,
        "n": {"g": None, "i": [{"j": "k", "l": {"m": 2}}]}, "o": [], "r": ["p", "q"], "t": {"s": 1}, "u": "1", "v": "null",
    }


def test_flatten_names(spark):
    df = spark.sql("SELECT named_struct('x.y', 1, 'z', named_struct('w', 2)) s, array(named_struct('q', 3)) l")
    flat = flatten(df)
    assert flat.columns == ["s__x.y", "s__z__w", "l"]
    assert tuple(flat.first()) == (1, 2, '[{"q":3}]')


def test_tsv_nulls_and_blanks(spark, tmp_path):
    write_tsv(spark.sql("SELECT 'a' x, '' y, CAST(NULL AS STRING) z, named_struct('q', 1.5D) s").coalesce(1), str(tmp_path / "t"))
    text = "".join(open(p).read() for p in glob.glob(f"{tmp_path}/t/part-*"))
    assert text == "x\ty\tz\ts__q\na\t\t\t1.5\n"


def test_output_names():
    assert output_name("E", "tsv") == "E.tsv"
    assert output_name("E", "tsv", "P") == "P-E.tsv"
    assert output_name("E", "tsv", "", "Q") == "E-Q.tsv"


def many_texts(frame, n=600):
    rows = [("c", "good", f"v{k % 3 if k % 2 else 0}", f"p{k % 50:02d}", f"text {k % 97} é\n" * (k % 5)) for k in range(n)]
    return rows, frame([*rows, *rows[:40]], ("cohort", "quality", "varname", "phv", "text"))


def joined(rows, part=None):
    """Texts per file, in order; cut where a row begins beyond a multiple of `part` bytes."""
    files, at = {}, {}
    for c, q, v, _, text in sorted(rows, key=lambda r: (r[:3], r[3], r[4])):
        name = f"{c}/{q}/{v}"
        cut = at.get(name, 0) // part if part else 0
        key = f"{name}-{cut + 1}.yaml" if cut else f"{name}.yaml"
        files[key] = files.get(key, "") + text
        at[name] = at.get(name, 0) + len(text.encode())
    return files


def test_places_are_prefix_sums_over_ranges(spark, frame, tmp_path):
    rows, df = many_texts(frame)
    rows = [*rows, *rows[:40]]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that a small table has several ranges
    try:
        placed = placed_texts(df, str(tmp_path / "ranged")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(str(tmp_path / "ranged")).select("range").distinct().count() > 1
    for name, text in joined(rows).items():
        mine = sorted((r for r in placed if f"{r.cohort}/{r.quality}/{r.varname}.yaml" == name), key=lambda r: (r["at"], r.phv, r.text))
        assert "".join(r.text * r.times for r in mine) == text
        whole = text.encode()
        assert all(whole[r["at"] : r["at"] + len(r.text.encode())] == r.text.encode() for r in mine)


def test_one_file_per_variable(spark, frame, tmp_path):
    rows, df = many_texts(frame)
    rows = [*rows, *rows[:40]]
    for part in (None, 900):
        for _ in range(2):  # a second run replaces the first
            write_spec_files(df, str(tmp_path / "specs"), **({"part_bytes": part} if part else {}))
        found = {str(p.relative_to(tmp_path / "specs")): p.read_text() for p in (tmp_path / "specs").rglob("*") if p.is_file()}
        found = {k: v for k, v in found.items() if not k.rsplit("/", 1)[-1].startswith(".")}
        if part is None:
            assert found == joined(rows)
        else:  # repeated texts stay together, so cuts may lie a little later
            assert len(found) > 3 and all(len(t.encode()) < 2 * part for t in found.values())
            whole = joined(rows)
            for name, text in whole.items():
                stem = name.removesuffix(".yaml")
                parts = sorted((k for k in found if k == name or k.startswith(f"{stem}-")), key=lambda k: int(k[len(stem) + 1 : -5] or 1) if k != name else 1)
                assert "".join(found[k] for k in parts) == text
    assert sorted(read_spec_files(spark, str(tmp_path / "specs"))) == sorted(found.values())


def test_no_spec_rows(frame, tmp_path):
    write_spec_files(frame([], ("cohort", "quality", "varname", "phv", "text")), str(tmp_path / "none"))
    assert not list((tmp_path / "none").rglob("*.yaml"))

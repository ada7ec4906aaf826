import gzip

import pytest

from conftest import records
from slotweave.errors import SourceError
from slotweave.plans.spec import parse_specs
from slotweave.sources.archive import (
    archive_catalog, archive_columns, archive_tables, header_columns, ragged_rows, read_after_blank_line, read_archive,
    referenced_tables,
)
from slotweave.sources.catalog import Catalog
from slotweave.sources.columns import column_catalogue, column_catalogue_of_files, resolve_placeholder, tables_of_references
from slotweave.sources.delimited import detect_separator, discover, load_exports, pick_sheet, read_metadata, read_table
from slotweave.sources.digests import data_dictionary, pair_digests


def archive(path, body, accessions="##\tphv00000001.v1.p1.c1\tphv00000002.v1.p1.c1\n"):
    text = "# Study accession: phs000000\n# more\n" + accessions + "dbGaP_Subject_ID\tSUBJECT_ID\tSEX\n\n" + body
    with gzip.open(path, "wt") as f:
        f.write(text)
    return str(path)


def test_header_line():
    assert header_columns("##\tphv00000001.v1.p1.c1\t\tphv00000002.v2") == ["dbGaP_Subject_ID", "phv00000001", "phv00000002"]


def test_archive_lines(spark, tmp_path):
    body = (
        "1\tS1\t2\n# late comment\n\n   \t\n2\tS2\t\nIntentionally Blank\t\t\n3\tS3 Intentionally Blank\t1\n"
        "dbGaP_Subject_ID\tSUBJECT_ID\tSEX\n4\tS4\n## second\tx\n5\tS5\t1\textra\n"
    )
    df = read_archive(spark, [archive(tmp_path / "phs1.v1.pht000001.v1.txt.gz", body)])
    assert df.columns == ["dbGaP_Subject_ID", "phv00000001", "phv00000002", "_beyond_header", "_source_file"]
    assert [tuple(r)[:4] for r in df.orderBy("dbGaP_Subject_ID").collect()] == [
        ("1", "S1", "2", None), ("2", "S2", None, None), ("4", "S4", None, None), ("5", "S5", "1", "extra"),
    ]
    (told,) = ragged_rows({"t": df, "u": df.drop("_beyond_header")})
    assert [tuple(r) for r in told.collect()] == [("t", "phs1.v1.pht000001.v1.txt.gz", 1)]


def test_archives_of_one_table_are_united(spark, tmp_path):
    a = archive(tmp_path / "a.pht000001.txt.gz", "1\tS1\t2\n")
    b = archive(tmp_path / "b.pht000001.txt.gz", "2\tS2\t7\n", "##\tphv00000001.v1\tphv00000009.v1\n")
    rows = records(read_archive(spark, [a, b]), "dbGaP_Subject_ID")
    assert [(r["phv00000001"], r["phv00000002"], r["phv00000009"], r["_source_file"]) for r in rows] == [
        ("S1", "2", None, "a.pht000001.txt.gz"),
        ("S2", None, "7", "b.pht000001.txt.gz"),
    ]


def test_archive_without_header(spark, tmp_path):
    path = tmp_path / "x.pht000001.txt.gz"
    with gzip.open(path, "wt") as f:
        f.write("a\tb\n")
    with pytest.raises(SourceError, match="no accession header"):
        read_archive(spark, [str(path)])


def test_header_after_blank_line(spark, tmp_path):
    path = tmp_path / "t.txt"
    path.write_text(
        "# c\nanything\n\n##\tphv00000001.v1.p1\tphv00000002.v2\ndbGaP_Subject_ID\tA\tB\n1\tx\ty\n2\tz\t\ndbGaP_Subject_ID\tk\tk\n"
    )
    df = read_after_blank_line(spark, [str(path)])
    assert df.columns[:3] == ["dbGaP_Subject_ID", "phv00000001", "phv00000002"]
    assert sorted(tuple(r)[:3] for r in df.collect()) == sorted(
        [("1", "x", "y"), ("2", "z", None), ("dbGaP_Subject_ID", "k", "k")], key=str
    )


def test_header_far_down_a_split_file(spark, tmp_path):
    """The file is read in many blocks."""
    path = tmp_path / "t.txt"
    rows = [f"{i}\tv{i}" for i in range(3000)]
    path.write_text("\n".join(["# c"] * 50 + ["", "##\tphv00000001.v1"] + rows) + "\n")
    want = {(str(i), f"v{i}") for i in range(3000)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = read_after_blank_line(spark, [str(path)])
        got = df.collect()
        assert df.columns == ["dbGaP_Subject_ID", "phv00000001", "_beyond_header", "_source_file"]
        assert len(got) == 3000 and {tuple(r)[:2] for r in got} == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    path.write_text("a\tb\n1\t2\n")
    with pytest.raises(SourceError, match="blank line"):
        read_after_blank_line(spark, [str(path)])


def test_pruning_by_specs(spark, tmp_path):
    raw, specs = tmp_path / "raw", tmp_path / "specs"
    raw.mkdir()
    (specs / "deep").mkdir(parents=True)
    for t in ("pht000001", "pht000002", "pht000099"):
        archive(raw / f"phs0.{t}.v1.txt.gz", "1\tS\t1\n")
    archive(raw / "unnamed.txt.gz", "1\tS\t1\n")
    assert set(archive_tables(spark, str(raw))) == {"pht000001", "pht000002", "pht000099"}
    assert set(archive_tables(spark, str(raw), str(tmp_path / "absent"))) == {"pht000001", "pht000002", "pht000099"}
    (specs / "a.yaml").write_text("populated_from: pht000001\n")
    (specs / "deep" / "b.yml").write_text("x: '{pht000002.phv1}'\n")
    assert set(archive_tables(spark, str(raw), str(specs))) == {"pht000001", "pht000002"}
    catalog = archive_catalog(spark, str(raw), str(specs))
    assert "pht000099" not in catalog and catalog["pht000001"].count() == 1


def job_count(spark, group):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("layout", ["markers", "blank"])
def test_headers_of_many_files_take_one_job(spark, tmp_path, layout):
    files = {}
    for k in range(12):
        accessions = f"##\tphv{k:08d}.v1.p1\tphv{k + 1:08d}.v2\n"
        path = tmp_path / f"a.pht{k:06d}.txt.gz"
        if layout == "markers":
            archive(path, f"{k}\tS\t1\n", accessions)
        else:
            with gzip.open(path, "wt") as f:
                f.write("# c\nanything\n\n" + accessions + f"{k}\tS\t1\textra\n")
        files[f"pht{k:06d}"] = [str(path)]
    spark.sparkContext.setJobGroup(f"headers-{layout}", "")
    catalog = archive_catalog(spark, str(tmp_path), layout=layout)
    before = job_count(spark, f"headers-{layout}")
    columns = {t: catalog[t].columns for t in catalog}
    assert job_count(spark, f"headers-{layout}") == before <= 4  # three to list, one for 12 headers; opening a table takes none
    assert columns["pht000003"][:3] == ["dbGaP_Subject_ID", "phv00000003", "phv00000004"]
    spark.sparkContext.setJobGroup(f"columns-{layout}", "")
    found = {(r["table"], r["column"]) for r in archive_columns(spark, files, layout).collect()}
    assert found == {(t, c) for t, cs in columns.items() for c in cs if not c.startswith("_")}
    row = catalog["pht000007"].first()
    assert (row[0], row["phv00000008"], row["_beyond_header"]) == ("7", "1", None if layout == "markers" else "extra")


def test_header_scan_stops_at_the_header(tmp_path):
    from slotweave.sources.files import headed, lines_of

    path = tmp_path / "t.txt.gz"
    with gzip.open(path, "wt") as f:
        f.write("# c\r\n## h\tphv1\r\n" + "1\t2\n" * 10)
    header, rest = headed(lines_of(str(path)), "markers")
    assert header == "## h\tphv1" and len(list(rest)) == 10
    assert headed(iter(["a", "b"]), "markers")[0] is None
    assert headed(iter(["a", "", "h"]), "blank")[0] == "h" and headed(iter(["a", ""]), "blank")[0] is None
    assert headed(iter([]), "first")[0] is None and headed(iter(["x"]), "first")[0] == "x"
    assert list(headed(iter(["", "h", "dbGaP_Subject_ID\tx", "1"]), "blank")[1]) == ["1"]
    assert list(headed(iter(["", "h", "0", "1"]), "blank")[1]) == ["0", "1"]


def test_references(frame):
    df = frame([("a pht1 b pht22",), ("pht1",), (None,)], ("value",))
    assert sorted(r.table_id for r in referenced_tables(df).collect()) == ["pht1", "pht22"]


def test_delimited(spark, tmp_path):
    (tmp_path / "My-Table.csv").write_text('a,b\n1,"x ""y"", z"\n,NA\n')
    (tmp_path / "other.tsv").write_text("a\tb,c\n1\t2\n")
    (tmp_path / "skip.txt").write_text("a\n1\n")
    csv, tsv = str(tmp_path / "My-Table.csv"), str(tmp_path / "other.tsv")
    assert (detect_separator(spark, csv), detect_separator(spark, tsv)) == (",", "\t")
    assert [tuple(r) for r in read_table(spark, csv).collect()] == [("1", 'x "y", z'), (None, "NA")]
    assert [tuple(r) for r in read_metadata(spark, csv).collect()] == [("1", 'x "y", z'), (None, None)]
    found = discover(spark, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in found] == ["My-Table.csv", "other.tsv"]
    assert discover(spark, str(tmp_path), ["x.tsv"]) == ["x.tsv"]
    catalog = Catalog.delimited(spark, found)
    assert sorted(catalog) == ["my_table", "other"]
    assert catalog["other"].columns == ["a", "b,c"]
    with pytest.raises(SourceError):
        catalog["missing"]
    catalog.create_views()
    assert spark.sql("SELECT count(*) AS n FROM my_table").first().n == 2


def test_sheets(frame):
    assert pick_sheet(["x", "right_join_full"]) == "right_join_full"
    assert pick_sheet(["x", "y"]) == "x"
    a = {"x": frame([("1",)], ("Var_Report.Study_ID",)), "right_join_full": frame([(" 2",)], ("study_id",))}
    b = {"first": frame([("2", "n")], ("study_id", "note"))}
    out = load_exports([a, b])
    assert {tuple(r) for r in out.select("study_id", "curator_note").collect()} == {("2", None), ("2", "n")}


def test_column_catalogue_and_placeholder(spark, frame):
    catalog = Catalog.of(spark, {"pht1": frame([("a",)], ("phv00000001",)), "pht2": frame([("a",)], ("phv00000002",))})
    texts = frame([("{phv00000001} and phv00000002 phv00000009",)], ("value",))
    found = {r.column: r.table for r in tables_of_references(texts, column_catalogue(catalog)).collect()}
    assert found == {"phv00000001": "pht1", "phv00000002": "pht2"}
    specs = parse_specs(["""
class_derivations:
  A:
    populated_from: FHS
    slot_derivations:
      k: {value: 1}
      s: {expr: '{phv00000002} * 2'}
      n:
        object_derivations:
        - class_derivations:
            B: {populated_from: FHS, slot_derivations: {v: {value: 2}}}
"""])
    (block,) = resolve_placeholder(specs, found, "FHS").classes
    assert block.populated_from == "pht2" and block.slots[2].objects[0].populated_from == "pht2"


def test_digests(spark, frame, tmp_path):
    dd = tmp_path / "phs1.v7.pht001920.v6.JHS_Subject.data_dict.xml"
    vr = tmp_path / "phs1.v7.pht001920.v6.p2.JHS_Subject.var_report.xml"
    lone = tmp_path / "phs1.v7.pht009.v6.Other.data_dict.xml"
    dd.write_text(
        '<data_table id="pht001920.v6"><variable id="phv00000001.v6"><name>SEX</name><description>Sex</description>'
        '<type>encoded</type><unit>u</unit><value code="1">Male</value><value code="2">Female</value></variable>'
        '<variable id="phv00000002.v6"><name>AGE</name><description>Age</description><type>num</type></variable></data_table>'
    )
    vr.write_text(
        '<data_table id="pht001920.v6.p2"><variable id="phv00000001.v6.p2" var_name="SEX" calculated_type="enum_integer"'
        ' units=""><description>Sex</description></variable></data_table>'
    )
    lone.write_text('<data_table><variable id="phv00000007.v1"><name>X</name></variable></data_table>')
    pairs, unmatched = pair_digests(frame([(str(dd),), (str(lone),)], ("path",)), frame([(str(vr),)], ("path",)))
    assert [(r.data_dict, r.var_report) for r in pairs.collect()] == [(str(dd), str(vr))]
    assert [r.data_dict for r in unmatched.collect()] == [str(lone)]
    rows = records(data_dictionary(spark, [str(dd), str(lone)], [str(vr)]), "variable")
    assert [(r["table"], r["variable"], r["name"], r["type"]) for r in rows] == [
        ("pht001920", "phv00000001", "SEX", "enum_integer"),
        ("pht001920", "phv00000002", "AGE", "num"),
    ]
    assert rows[0]["codes"] == {"1": "Male", "2": "Female"}


def test_cells_with_line_breaks_and_extra_cells(spark, tmp_path):
    (tmp_path / "m.csv").write_text('phv,desc,pht\nphv1,"line one\nline two",pht1\nphv2,x\n')
    rows = sorted(tuple(r) for r in read_metadata(spark, str(tmp_path / "m.csv")).collect())
    assert rows == [("phv1", "line one\nline two", "pht1"), ("phv2", "x", None)]
    for k, row in enumerate(["1,2,3", "1,2,,4", "1,2,,", '"1,5",2,"x"', '1,"2\nb",3']):
        (tmp_path / f"x{k}.csv").write_text(f"a,b\n7,8\n{row}\n")
        for act in (lambda df: df.collect(), lambda df: df.count(), lambda df: df.select("b").collect()):
            with pytest.raises(Exception, match="more cells than the header"):
                act(read_table(spark, str(tmp_path / f"x{k}.csv"), breaks=True))
    (tmp_path / "y.csv").write_text('a,b,c\n"1,2",3\n"x, ""y"", z"\n1,"2,3,4",5\n')
    got = sorted(tuple(r) for r in read_table(spark, str(tmp_path / "y.csv")).collect())
    assert got == [("1", "2,3,4", "5"), ("1,2", "3", None), ('x, "y", z', None, None)]


def test_columns_of_many_files_from_one_job(spark, tmp_path):
    want = set()
    for i in range(150):
        sep = ",\t"[i % 2]
        names = ["id", f"phv{i:08d}", f'"x{sep}{i}"', ""]
        (tmp_path / f"pht-{i}.csv").write_text(sep.join(names) + "\n1\n")
        want |= {(f"pht_{i}", "id"), (f"pht_{i}", f"phv{i:08d}"), (f"pht_{i}", f"x{sep}{i}")}
    (tmp_path / "empty.tsv").write_text("")
    (tmp_path / "marked.csv").write_text("\ufeffa,b\n")
    spark.range(3).selectExpr("id AS `odd name`", "id AS b").repartition(2).write.parquet(str(tmp_path / "folder.parquet"))
    want |= {("marked", "a"), ("marked", "b"), ("folder", "odd name"), ("folder", "b")}
    paths = [str(p) for p in sorted(tmp_path.iterdir())]
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    got = [(r["table"], r["column"]) for r in column_catalogue_of_files(spark, paths).collect()]
    assert len(set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - set(before)) == 1
    assert len(got) == len(want) and set(got) == want
    assert column_catalogue_of_files(spark, []).collect() == []


def test_columns_of_a_folder_without_parts(spark, tmp_path):
    (tmp_path / "none.parquet").mkdir()
    with pytest.raises(Exception, match="holds no part file"):
        column_catalogue_of_files(spark, [str(tmp_path / "none.parquet")]).collect()

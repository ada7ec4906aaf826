import pytest

from slotweave.operators.profile import (
    InferenceOptions, Slice, exact_distinct, infer_table, key_columns, profile_columns, sliced, surviving_counts, unique_columns,
)


@pytest.fixture(scope="module")
def people(frame):
    return frame(
        [("s1", "4", "1.5", "2024-01-02", "5 mg", "Yes", None, "k1"), ("s2", "5", "2", "2023-12-31", "6.5 mg", "No", None, "k2"),
         ("s3", None, ".5e3", None, None, "Yes", None, "k3")],
        ("id", "n", "f", "d", "m", "e", "z", "k"),
    )


def test_types(people):
    got = {r.column: r.type for r in profile_columns(people).collect()}
    assert got == {"id": "string", "n": "integer", "f": "float", "d": "date", "m": "measurement", "e": "string", "z": "string", "k": "string"}


def test_profile_is_one_aggregate(people):
    plan = profile_columns(people)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_profile_of_a_wide_table(spark):
    df = spark.range(50).selectExpr(*[f"cast(id * {k} AS string) AS c{k}" for k in range(1000)])
    got = profile_columns(df).collect()
    assert sorted((r.position, r.column, r.n_rows, r.type) for r in got) == [(k, f"c{k}", 50, "integer") for k in range(1000)]
    assert {r.n_present for r in got} == {50} and len(profile_columns(df.limit(0).select("c1")).collect()) == 1


def test_counts(people):
    row = profile_columns(people, exact=True).filter("column = 'm'").first()
    assert (row.n_rows, row.n_present, row.n_distinct, row.min_length, row.max_length, row.example) == (3, 2, 2, 4, 6, "6.5 mg")
    assert profile_columns(people, exact=True).filter("column = 'z'").first().n_distinct == 0
    assert {r.column: r.n_distinct for r in exact_distinct(people, ["e", "id"]).collect()} == {"e": 2, "id": 3}


def test_typed_columns(spark):
    df = spark.sql("SELECT 1L a, 1.5D b, DATE'2024-01-01' c, array(1) d")
    assert {r.column: r.type for r in profile_columns(df).collect()} == {"a": "integer", "b": "float", "c": "date"}


def test_keys(people):
    keys = {r.column: r.role for r in unique_columns(profile_columns(people, exact=True)).collect()}
    assert keys == {"id": "identifier", "f": "unique_key", "k": "unique_key"}


@pytest.mark.parametrize(
    ("options", "enum"),
    [(InferenceOptions(), False), (InferenceOptions(max_enum_size=2), True), (InferenceOptions(max_enum_size=1), False),
     (InferenceOptions(0.5, 2), False), (InferenceOptions(0.7, 2), True)],
)
def test_enum_knobs(people, options, enum):
    slots, enums, keys = infer_table(people, options)
    assert (slots["e"].range == "e_enum") is enum
    assert enums.get("e_enum") == (("No", "Yes") if enum else None)
    assert slots["id"].identifier and not slots["k"].identifier and keys == ("f", "k")


@pytest.fixture(scope="module")
def wide(spark):
    many = [f"cast(id * {k} AS string) AS k{k}" for k in range(1, 4)] + [f"cast(id % {m} AS string) AS m{m}" for m in (2, 9, 500, 2999)]
    late = "CASE WHEN id = 2999 THEN 'x0' ELSE 'x' || id END AS late"  # one repeated value in 3000
    return spark.range(3000).selectExpr(*many, late, "CASE WHEN id > 5 THEN 'v' || id END AS gaps", "CAST(NULL AS string) AS none")


def test_slices_disprove_and_never_err(wide):
    seen = sliced(wide, wide.columns, 3000, slice_values=100)
    assert not any(seen[c].repeated for c in ("k1", "k2", "k3", "gaps", "none"))
    assert seen["m500"].repeated and 1 < seen["m500"].values < 500 and not seen["m500"].whole
    assert 50 < seen["k1"].values < 200 and seen["none"] == Slice(False, 0, False)
    whole = sliced(wide, ["m9", "late"], 3000, slice_values=5000)
    assert whole == {"m9": Slice(True, 9, True), "late": Slice(True, 2999, True)}


@pytest.mark.parametrize("slice_values", [1, 7, 100, 1500, 10_000])
def test_survivors_are_counted_exactly(wide, slice_values):
    complete = set(wide.columns) - {"gaps", "none"}
    counts = surviving_counts(wide, 3000, complete, set(wide.columns), 9, slice_values)
    assert {c for c in complete if counts.get(c) == 3000} == {"k1", "k2", "k3"}
    assert {c for c in counts if counts[c] <= 9} == {"m2", "m9"} | ({"none"} & set(counts))
    assert [tuple(r) for r in key_columns(wide, slice_values).collect()] == [
        (0, "k1", "identifier"), (1, "k2", "unique_key"), (2, "k3", "unique_key"),
    ]


def test_keys_of_odd_tables(spark):
    assert key_columns(spark.range(0)).collect() == []
    assert key_columns(spark.sql("SELECT array(1) a")).collect() == []
    assert [r["column"] for r in key_columns(spark.sql("SELECT 1 `a.b`, CAST(NULL AS int) c")).collect()] == ["a.b"]


def test_only_survivors_move_all_their_values(spark):
    """Shuffled bytes of a table of many near-keys against counting them all."""
    df = spark.range(60_000).selectExpr(*[f"cast(hash(id % {59_000 - k}) AS string) AS c{k}" for k in range(12)])
    written = lambda: spark._jsc.sc().statusStore().executorList(True).head().totalShuffleWrite()
    before = written()
    assert surviving_counts(df, 60_000, set(df.columns), set(), 0, 1000) == {}
    moved = written() - before
    exact_distinct(df, df.columns).collect()
    assert moved < 0.1 * (written() - before - moved)

"""Exact semantics on hand-worked and generated micro-fixtures.

Each case is checked three ways: the per-pair plan, the single-pass grid, and
a brute-force DuckDB statement written the way the original jobs query
(per-file DISTINCT, UNION ALL, NOT IN, NULL-matching merges).
"""

from __future__ import annotations

import datetime as dt
import random

import pytest
from fixtures import (MICRO_ADM, MICRO_BENE, MICRO_BOOK, MICRO_EXPECTED, duck, frames,
                      rows_of)
from pyspark.sql import functions as F

from lookback.oracle import pair_sql
from lookback.plans.grid import feature_grid, feature_grid_long
from lookback.plans.matrix import feature_matrix
from lookback.plans.pair import condition_feature
from lookback.sources.codebook import read_codebook

Y, F0 = 2003, 2000


@pytest.fixture(scope="module")
def micro(spark):
    ev, en = frames(spark, MICRO_ADM, MICRO_BENE)
    return ev, en, read_codebook(spark, MICRO_BOOK)


def _pair_rows(df):
    return rows_of(tuple(r) for r in df.collect())


@pytest.mark.parametrize("cond", ["A", "P", "F", "X"])
def test_micro_pair_matches_hand_worked_table(micro, cond):
    ev, en, cb = micro
    got = {r.bene_id: (r[cond], r[f"{cond}_ever"])
           for r in condition_feature(ev, en, cb, cond, Y, F0).collect()}
    assert got == {b: exp[cond] for b, exp in MICRO_EXPECTED.items()}


def test_micro_grid_matches_hand_worked_table(micro):
    ev, en, cb = micro
    wide = feature_grid(ev, en, cb, [Y], F0).collect()
    assert len(wide) == len(MICRO_EXPECTED)
    for r in wide:
        for cond in MICRO_BOOK:
            assert (r[cond], r[f"{cond}_ever"]) == MICRO_EXPECTED[r.bene_id][cond], (r.bene_id, cond)


def test_window_exclusion_scope_changes_only_b5(micro):
    ev, en, cb = micro
    compat = {r.bene_id: r.X for r in condition_feature(ev, en, cb, "X", Y, F0).collect()}
    window = {r.bene_id: r.X for r in condition_feature(ev, en, cb, "X", Y, F0,
                                                        exclusion_scope="window").collect()}
    assert compat["b5"] == 1 and window["b5"] == 0
    assert {k: v for k, v in compat.items() if k != "b5"} == {k: v for k, v in window.items() if k != "b5"}
    grid = {r.bene_id: r.X for r in feature_grid(ev, en, cb, [Y], F0, "window").collect()}
    assert grid == window


def test_micro_against_bruteforce_sql(micro):
    ev, en, cb = micro
    con = duck(MICRO_ADM, MICRO_BENE)
    for cond, entry in MICRO_BOOK.items():
        for y in range(F0, Y + 1):
            want = rows_of(con.execute(pair_sql(cond, entry, y, first_year=F0)).fetchall())
            got = _pair_rows(condition_feature(ev, en, cb, cond, y, F0))
            assert got == want, (cond, y)


def test_matrix_column_order_and_null_id_drop(spark):
    adm = MICRO_ADM + [(None, dt.date(2003, 5, 5), 2003, ["410.01"])]
    bene = MICRO_BENE + [(None, 2003, 0)]
    ev, en = frames(spark, adm, bene)
    cb = read_codebook(spark, MICRO_BOOK)
    m = feature_matrix(ev, en, cb, [Y], F0)
    assert m.columns == ["bene_id", "X", "X_ever", "F", "F_ever", "P", "P_ever", "A", "A_ever", "rfrnc_yr"]
    ids = [r.bene_id for r in m.collect()]
    assert None not in ids and len(ids) == 7
    # the per-pair table keeps the NULL id: status from NULL-safe matches, no first date
    pair = {r.bene_id: (r.A, r.A_ever) for r in condition_feature(ev, en, cb, "A", Y, F0).collect()}
    assert pair[None] == (3, None)


def test_null_id_in_exclusion_set_blocks_everyone(spark):
    # a NULL id with an exclusion code in the oldest window file (2001)
    adm = MICRO_ADM + [(None, dt.date(2001, 6, 6), 2001, ["S06.1"])]
    ev, en = frames(spark, adm, MICRO_BENE)
    cb = read_codebook(spark, MICRO_BOOK)
    pair = {r.bene_id: r.X for r in condition_feature(ev, en, cb, "X", Y, F0).collect()}
    assert pair["b5"] == 0  # would be 1 without the NULL in the set
    grid = {r.bene_id: r.X for r in feature_grid(ev, en, cb, [Y], F0).collect()}
    assert grid == pair


def test_null_outer_id_survives_only_empty_exclusion_set(spark):
    book = {"E": {"ref_period": 1, "icd9": ["331.0"], "icd10": [],
                  "icd9_exclusion": ["999"], "icd10_exclusion": ["998"]}}
    cb = read_codebook(spark, book)
    adm = [(None, dt.date(2003, 1, 1), 2003, ["331.0"])]
    bene = [(None, 2003, 0), ("b1", 2003, 0)]
    ev, en = frames(spark, adm, bene)
    # empty exclusion set: the NULL id meets the rule -> status 3
    assert {r.bene_id: r.E for r in condition_feature(ev, en, cb, "E", Y, F0).collect()}[None] == 3
    assert {r.bene_id: r.E for r in feature_grid(ev, en, cb, [Y], F0).collect()}[None] == 3
    # non-empty exclusion set (someone else): NULL NOT IN (...) is not true -> status 2
    ev2, _ = frames(spark, adm + [("b9", dt.date(2003, 2, 2), 2003, ["999"])], bene)
    assert {r.bene_id: r.E for r in condition_feature(ev2, en, cb, "E", Y, F0).collect()}[None] == 2
    assert {r.bene_id: r.E for r in feature_grid(ev2, en, cb, [Y], F0).collect()}[None] == 2


def test_duplicate_enrolment_rows_are_kept(spark):
    bene = MICRO_BENE + [("b1", 2003, 0), ("b1", 2003, 0)]
    ev, en = frames(spark, MICRO_ADM, bene)
    cb = read_codebook(spark, MICRO_BOOK)
    pair = condition_feature(ev, en, cb, "A", Y, F0).where(F.col("bene_id") == "b1").collect()
    assert [(r.A, r.A_ever) for r in pair] == [(3, dt.date(2003, 3, 1))] * 3
    grid = feature_grid(ev, en, cb, [Y], F0).where(F.col("bene_id") == "b1").collect()
    assert len(grid) == 3
    # coverage sums every enrolment row of the window, duplicates included
    bene2 = MICRO_BENE + [("b1", 2003, 2)]
    ev, en = frames(spark, MICRO_ADM, bene2)
    assert {r.A for r in condition_feature(ev, en, cb, "A", Y, F0)
            .where(F.col("bene_id") == "b1").collect()} == {1}


def test_exclusion_list_modes(spark):
    book = {"I9": {"ref_period": 1, "icd9": ["331.0"], "icd10": [], "icd9_exclusion": ["S06.1"]},
            "I10": {"ref_period": 1, "icd9": ["331.0"], "icd10": [],
                    "icd10_exclusion": ["S06.2", "S06.1"]}}
    compat = read_codebook(spark, book)
    assert compat.spec("I9").n_exclude == 0          # ICD-9 only: ignored
    assert compat.spec("I10").n_exclude == 1         # ICD-10 only: first code only
    assert {r.code for r in compat.exclude_codes("I10").collect()} == {"S06.2"}
    full = read_codebook(spark, book, exclusion_codes="all")
    assert full.spec("I9").n_exclude == 1 and full.spec("I10").n_exclude == 2
    ev, en = frames(spark, MICRO_ADM, MICRO_BENE)
    # b5 carries S06.1 in 2003: excluded only when the list is used in full
    st = {r.bene_id: r.I10 for r in condition_feature(ev, en, compat, "I10", Y, F0).collect()}
    assert st["b5"] == 1
    st = {r.bene_id: r.I10 for r in condition_feature(ev, en, full, "I10", Y, F0).collect()}
    assert st["b5"] == 0


def test_window_truncated_at_first_year(micro):
    ev, en, cb = micro
    # X looks back 3 years; in 2001 the window is 2000-2001 and its oldest year 2000
    got = _pair_rows(condition_feature(ev, en, cb, "X", 2001, F0))
    con = duck(MICRO_ADM, MICRO_BENE)
    assert got == rows_of(con.execute(pair_sql("X", MICRO_BOOK["X"], 2001, first_year=F0)).fetchall())


def test_errors(spark, micro):
    ev, en, cb = micro
    with pytest.raises(ValueError):
        condition_feature(ev, en, cb, "A", 1999, F0)          # empty window
    with pytest.raises(ValueError):
        condition_feature(ev, en, cb, "nope", Y, F0)          # unknown condition
    with pytest.raises(ValueError):
        read_codebook(spark, {"Z": {"ref_period": 1, "claims_criteria": "third", "icd9": ["1"]}})
    with pytest.raises(ValueError):
        read_codebook(spark, {"Z": {"icd9": ["1"]}})          # no ref_period
    with pytest.raises(ValueError):
        feature_grid(ev, en, cb, [1999], F0)


CODES = ["410.01", "250.00", "331.0", "S06.1", "S06.2", "V1", None]
IDS = ["a", "b", "c", "d", None]


def _random_fixture(rng: random.Random):
    adm = []
    for _ in range(rng.randint(5, 30)):
        y = rng.randint(F0, Y)
        arr = rng.choice([None, [], [rng.choice(CODES) for _ in range(rng.randint(1, 4))]])
        adm.append((rng.choice(IDS), dt.date(y, rng.randint(1, 12), rng.randint(1, 28)), y, arr))
    bene = []
    for _ in range(rng.randint(4, 16)):
        bene.append((rng.choice(IDS), rng.randint(F0, Y), rng.choice([0, 0, 0, 1, 5, None])))
    return adm, bene


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_random_fixtures_grid_and_pair_against_bruteforce(spark, seed):
    rng = random.Random(seed)
    adm, bene = _random_fixture(rng)
    ev, en = frames(spark, adm, bene)
    cb = read_codebook(spark, MICRO_BOOK)
    con = duck(adm, bene)
    years = list(range(F0, Y + 1))
    for scope in ("oldest_year", "window"):
        grid = feature_grid_long(ev, en, cb, years, F0, scope).collect()
        for cond, entry in MICRO_BOOK.items():
            for y in years:
                want = rows_of(con.execute(pair_sql(cond, entry, y, scope=scope, first_year=F0)).fetchall())
                got = rows_of((r.bene_id, r.rfrnc_yr, r.status, r.ever) for r in grid
                              if r.condition == cond and r.rfrnc_yr == y)
                assert got == want, (seed, scope, cond, y)
                if y == Y:
                    pair = _pair_rows(condition_feature(ev, en, cb, cond, y, F0, exclusion_scope=scope))
                    assert pair == want, (seed, scope, cond, y, "pair")


def test_long_form_events_equal_array_form(micro):
    ev, en, cb = micro
    long = ev.select("bene_id", "admission_date", "file_year",
                     F.posexplode("diagnoses").alias("pos", "code"))
    for cond in MICRO_BOOK:
        assert _pair_rows(condition_feature(long, en, cb, cond, Y, F0)) == \
            _pair_rows(condition_feature(ev, en, cb, cond, Y, F0))
    a = rows_of(tuple(r) for r in feature_grid(ev, en, cb, range(F0, Y + 1), F0).collect())
    b = rows_of(tuple(r) for r in feature_grid(long, en, cb, range(F0, Y + 1), F0).collect())
    assert a == b


def test_hot_id_holds_a_third_of_the_rows(spark):
    """One id with a third of all events and of all enrolment rows (copies):
    every copy keeps its row and the values match the brute-force SQL."""
    rng = random.Random(11)
    adm, bene = [], []
    for i in range(600):
        y = F0 + i % 4
        who = "hot" if i % 3 == 0 else f"p{i % 50}"
        adm.append((who, dt.date(y, 1 + i % 12, 1 + i % 28), y,
                    [rng.choice(CODES[:-1]) for _ in range(1 + i % 3)]))
    for i in range(300):
        y = F0 + i % 4
        who = "hot" if i % 3 == 0 else f"p{i % 50}"
        bene.append((who, y, rng.choice([0, 0, 1])))
    ev, en = frames(spark, adm, bene)
    cb = read_codebook(spark, MICRO_BOOK)
    con = duck(adm, bene)
    grid = feature_grid_long(ev, en, cb, [Y], F0).collect()
    assert sum(1 for r in grid if r.bene_id == "hot" and r.condition == "A") == 25
    for cond, entry in MICRO_BOOK.items():
        want = rows_of(con.execute(pair_sql(cond, entry, Y, first_year=F0)).fetchall())
        got = rows_of((r.bene_id, r.rfrnc_yr, r.status, r.ever) for r in grid if r.condition == cond)
        assert got == want, cond


def test_grid_on_year_gaps_and_partitioned_source(spark, tmp_path):
    from lookback.sources.yearly import read_partitioned
    ev, en = frames(spark, MICRO_ADM, MICRO_BENE)
    ev.write.partitionBy("file_year").parquet(str(tmp_path / "adm"))
    en.write.partitionBy("file_year").parquet(str(tmp_path / "bene"))
    pev = read_partitioned(spark, str(tmp_path / "adm"), range(F0, Y + 1))
    pen = read_partitioned(spark, str(tmp_path / "bene"), range(F0, Y + 1))
    cb = read_codebook(spark, MICRO_BOOK)
    grid = feature_grid_long(pev, pen, cb, [2001, 2003], F0).collect()
    assert {r.rfrnc_yr for r in grid} <= {2001, 2003}
    for cond in MICRO_BOOK:
        for y in (2001, 2003):
            got = rows_of((r.bene_id, r.rfrnc_yr, r.status, r.ever) for r in grid
                          if r.condition == cond and r.rfrnc_yr == y)
            assert got == _pair_rows(condition_feature(ev, en, cb, cond, y, F0)), (cond, y)
    plan = condition_feature(pev, pen, cb, "A", 2003, F0)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(file_year" in plan


def test_condition_names_with_dots_and_spaces(spark):
    book = {"ra.oa": MICRO_BOOK["A"], "heart failure": MICRO_BOOK["P"], "x`y": MICRO_BOOK["X"]}
    ev, en = frames(spark, MICRO_ADM, MICRO_BENE)
    cb = read_codebook(spark, book)
    m = feature_matrix(ev, en, cb, [Y], F0)
    assert m.columns == ["bene_id", "x`y", "x`y_ever", "heart failure", "heart failure_ever",
                         "ra.oa", "ra.oa_ever", "rfrnc_yr"]
    got = {r["bene_id"]: (r["ra.oa"], r["heart failure"], r["x`y"]) for r in m.collect()}
    assert got == {b: (e["A"][0], e["P"][0], e["X"][0]) for b, e in MICRO_EXPECTED.items()}
    from lookback.plans.matrix import merge_chain
    frames_ = [(c, condition_feature(ev, en, cb, c, Y, F0)) for c in cb.names]
    assert merge_chain(frames_, Y).count() == 7


def _random_book(rng: random.Random) -> dict:
    codes = [c for c in CODES if c is not None]
    book = {}
    for k in range(4):
        entry = {"ref_period": rng.randint(1, 4),
                 "claims_criteria": rng.choice(["all", "primary", "first_two"]),
                 "icd9": rng.sample(codes, rng.randint(1, 2)), "icd10": rng.sample(codes, rng.randint(0, 1))}
        shape = rng.choice(["none", "icd9", "icd10", "both"])
        if shape in ("icd9", "both"):
            entry["icd9_exclusion"] = rng.sample(codes, 1)
        if shape in ("icd10", "both"):
            entry["icd10_exclusion"] = rng.sample(codes, 2)
        book[f"r{k}"] = entry
    return book


@pytest.mark.parametrize("seed", [21, 22, 23])
def test_random_codebooks_grid_against_bruteforce(spark, seed):
    rng = random.Random(seed)
    adm, bene = _random_fixture(rng)
    book = _random_book(rng)
    ev, en = frames(spark, adm, bene)
    cb = read_codebook(spark, book)
    con = duck(adm, bene)
    years = list(range(F0, Y + 1))
    for scope in ("oldest_year", "window"):
        grid = feature_grid_long(ev, en, cb, years, F0, scope).collect()
        for cond, entry in book.items():
            for y in years:
                want = rows_of(con.execute(pair_sql(cond, entry, y, scope=scope, first_year=F0)).fetchall())
                got = rows_of((r.bene_id, r.rfrnc_yr, r.status, r.ever) for r in grid
                              if r.condition == cond and r.rfrnc_yr == y)
                assert got == want, (seed, scope, cond, y, entry)

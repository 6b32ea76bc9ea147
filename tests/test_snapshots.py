"""Publishing by pointer: all or nothing, overtaken writers, pruned reads."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from strata.operators.aggregates import DISTINCT_ERROR, column_profile
from strata.plans import gold as g
from strata.plans import monthly, quality
from strata.plans.profiles import bronze_profile
from strata.plans.silver import STG_POZOS_SCHEMA, STG_PRODUCCION_SCHEMA
from strata.sources import snapshots
from strata.sources.bronze import loads_since, scan_bronze, table_columns
from strata.sources.snapshots import ConcurrentChangeError, Transaction, current, expire
from strata.sources.tables import merge_upsert, read_layer, write_layer
from tests.conftest import (
    PRODUCTION_COLUMNS,
    PRODUCTION_ROWS,
    WELL_COLUMNS,
    WELL_ROWS,
    load,
    load_fixture,
    production,
    text_frame,
)

NOW = datetime(2024, 4, 20)
MONTHS = "periodo date, n int, _loaded_at timestamp"


class Killed(RuntimeError):
    """The writer is gone."""


def months(spark, *rows):
    made = [(m, n, "2024-01-01") for m, n in rows]
    return spark.createDataFrame(made, "periodo string, n int, _loaded_at string").select(
        F.col("periodo").cast("date"), "n", F.col("_loaded_at").cast("timestamp")
    )


def seen(held, table):
    return sorted((str(r.periodo), r.n) for r in held.read(table).collect())


def state(spark, root):
    """Rows of every table, as a reader sees them."""
    held = current(spark, root)
    return {name: sorted(map(str, held.read(name).collect())) for name in held.tables}


def second_load(spark, root):
    rows = [tuple({"prod_gas": "1.0", "empresa": "New Name"}.get(c, v) for c, v in zip(PRODUCTION_COLUMNS, row))
            for row in PRODUCTION_ROWS[:2]]
    load_fixture(spark, root, "2024-02", datetime(2024, 4, 2), rows, [*WELL_ROWS, ("9", *WELL_ROWS[0][1:])])


def test_a_run_that_dies_anywhere_leaves_all_old_or_all_new(spark, root, monkeypatch):
    load_fixture(spark, root)
    monthly.transform(spark, root, now=NOW)
    second_load(spark, root)
    old = state(spark, root)
    write, publish = Transaction.write, snapshots.publish_text
    steps = {"n": 0}

    def dying_write(self, *args, **kwargs):
        steps["n"] -= 1
        if steps["n"] == 0:
            raise Killed
        return write(self, *args, **kwargs)

    # Before each of the tables is written, and then right before the pointer is.
    monkeypatch.setattr(Transaction, "write", dying_write)
    for step in range(1, 11):
        steps["n"] = step
        with pytest.raises(Killed):
            monthly.transform(spark, root, now=NOW)
        assert state(spark, root) == old, step
    monkeypatch.setattr(Transaction, "write", write)

    def dying_publish(session, path, text):
        raise Killed

    monkeypatch.setattr(snapshots, "publish_text", dying_publish)
    with pytest.raises(Killed):
        monthly.transform(spark, root, now=NOW)
    assert state(spark, root) == old

    def late_death(session, path, text):
        publish(session, path, text)
        raise Killed

    monkeypatch.setattr(snapshots, "publish_text", late_death)
    with pytest.raises(Killed):
        monthly.transform(spark, root, now=NOW)
    monkeypatch.setattr(snapshots, "publish_text", publish)
    new = state(spark, root)
    assert new != old
    monthly.transform(spark, root, now=NOW)
    assert state(spark, root) == new


@pytest.mark.parametrize("step", ["write", "pointer"])
def test_a_load_that_is_cut_off_leaves_the_old_rows(spark, root, monkeypatch, step):
    load_fixture(spark, root, "2024-01")
    before = state(spark, root)
    new = production(spark, {"prod_gas": "3"})
    if step == "pointer":
        monkeypatch.setattr(snapshots, "publish_text", lambda *args: (_ for _ in ()).throw(Killed()))
    else:
        new = new.withColumn("mes", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception):
        load(new, root, "produccion_raw", "2024-01", datetime(2024, 4, 1))
    monkeypatch.undo()
    assert state(spark, root) == before


def test_readers_keep_their_snapshot(spark, root):
    write_layer(months(spark, ("2024-01-01", 1), ("2024-02-01", 2)), root, "gold", "t", "periodo")
    old = current(spark, root)
    merge_upsert(months(spark, ("2024-01-01", 5)), root, "gold", "t", ["periodo"], MONTHS)
    assert seen(old, "gold/t") == [("2024-01-01", 1), ("2024-02-01", 2)]
    assert seen(current(spark, root), "gold/t") == [("2024-01-01", 5), ("2024-02-01", 2)]
    # An expired snapshot takes only the folders with it that newer ones do not name.
    gone = expire(spark, root, keep=1)
    assert len(gone) == 1 and "periodo=2024-01-01" in gone[0]
    assert seen(current(spark, root), "gold/t") == [("2024-01-01", 5), ("2024-02-01", 2)]


def test_overtaken_writers(spark, root):
    write_layer(months(spark, ("2024-01-01", 1), ("2024-02-01", 2)), root, "gold", "t", "periodo")
    one, two, three = (Transaction(spark, root) for _ in range(3))
    for change, month in ((one, "2024-01-01"), (two, "2024-02-01"), (three, "2024-01-01")):
        change.write(months(spark, (month, 9)), "gold/t", "periodo", replace=[f"periodo={month}"])
    one.commit()
    two.commit()  # another month, so it is applied on top
    assert seen(current(spark, root), "gold/t") == [("2024-01-01", 9), ("2024-02-01", 9)]
    with pytest.raises(ConcurrentChangeError):
        three.commit()
    other = Transaction(spark, root)
    write_layer(months(spark), root, "gold", "t", "periodo")
    other.write(months(spark), "gold/t", "periodo")
    with pytest.raises(ConcurrentChangeError):
        other.commit()
    assert current(spark, root).read("gold/t").collect() == []
    assert read_layer(spark, root, "gold", "never", "a int").collect() == []
    with pytest.raises(FileNotFoundError):
        read_layer(spark, root, "gold", "never")


def files(df):
    return {f.split("version=")[1].split("/")[0] + "|" + f.rsplit("/", 2)[1] for f in df.inputFiles()}


def test_only_loads_that_matter_are_read(spark, root):
    for month, at in (("1", 2), ("2", 3), ("3", 4)):
        load(production(spark, {"mes": month}, {"mes": " "}, {"anio": ""}), root, "produccion_raw",
             f"2024-0{month}", datetime(2024, at, 1))
    load(text_frame(spark, ["idpozo", "note"], [("1", "x")]), root, "produccion_raw", "none", datetime(2024, 1, 1))
    load(production(spark, {"mes": "July"}), root, "produccion_raw", "odd", datetime(2024, 1, 2))
    held = current(spark, root)
    newest = held.parts("bronze/produccion_raw")["_load_period=2024-02"]["newest"]

    def chosen(*args):
        return sorted(k.split("=")[1] for k in loads_since(held, "produccion_raw", *args))

    assert chosen(newest) == ["2024-03"]
    # Loads whose months are not known may hold any.
    assert chosen(newest, "2024-01-01") == ["2024-01", "2024-03", "none", "odd"]
    assert chosen(None, "2024-02-01") == ["2024-02", "none", "odd"]
    assert "note" in table_columns(held, "produccion_raw")
    pruned = scan_bronze(spark, root, "produccion_raw", loads_since(held, "produccion_raw", newest))
    assert {f.split("|")[1] for f in files(pruned)} == {"_load_period=2024-03"}
    assert "note" in pruned.columns and pruned.count() == 3
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan


def star_rows(star):
    return {name: sorted(map(str, getattr(star, name).drop("valid_from").collect())) for name in g.GOLD_SCHEMAS}


def test_later_runs_read_what_changed_and_equal_a_full_rebuild(spark, root, monkeypatch):
    load_fixture(spark, root)
    monthly.transform(spark, root, now=NOW)
    # The correction leaves the only report of an area, so the area has to go.
    cells = dict(zip(PRODUCTION_COLUMNS, PRODUCTION_ROWS[3]), area="Moved", empresa="Renamed", prod_agua="1")
    rows = [tuple(cells[c] for c in PRODUCTION_COLUMNS)]
    wells = [tuple({"area": "Moved", "sigla": "new"}.get(c, v) for c, v in zip(WELL_COLUMNS, WELL_ROWS[2]))]
    load_fixture(spark, root, "2024-02", datetime(2024, 4, 2), rows, wells)
    read, tested = [], []
    from_table, gate = snapshots.Snapshot.read, quality.quality_gate

    def noted(self, table, schema=None, keys=None):
        read.append((table, None if keys is None else tuple(keys)))
        return from_table(self, table, schema, keys)

    def noted_gate(tables, suite, where=None, untested=None):
        tested.append({name: files(df) for name, df in untested.items()})
        plan = quality.run_tests(tables, suite, untested)._jdf.queryExecution().executedPlan().toString()
        tested.append(plan)
        return gate(tables, suite, where, untested)

    monkeypatch.setattr(snapshots.Snapshot, "read", noted)
    monkeypatch.setattr(quality, "quality_gate", noted_gate)
    star = monthly.transform(spark, root, now=NOW)
    monkeypatch.undo()
    assert ("bronze/produccion_raw", ("_load_period=2024-02",)) in read
    assert ("bronze/pozos_raw", ("_load_period=2024-02",)) in read
    assert not any(t.startswith("bronze/") and keys in (None, ()) for t, keys in read)
    one_month = ("periodo=2024-01-01",)
    assert ("silver/stg_produccion", one_month) in read and ("gold/fct_produccion", one_month) in read
    # The tests of single months look at the month that has changed.
    assert {f.split("|")[1] for f in tested[0]["stg_produccion"]} == set(one_month)
    assert {f.split("|")[1] for f in tested[2]["fct_produccion"]} == set(one_month)
    incremental = star_rows(star)
    assert any("Moved" in row for row in incremental["dim_area"])
    assert not any("Seco" in row for row in incremental["dim_area"])
    pozos = read_layer(spark, root, "silver", "stg_pozos", STG_POZOS_SCHEMA)
    reports = read_layer(spark, root, "silver", "stg_produccion", STG_PRODUCCION_SCHEMA)
    assert star_rows(g.build_gold(pozos, reports)) == incremental
    assert star_rows(monthly.transform(spark, root, now=NOW, full_refresh=True)) == incremental


def test_a_reloaded_well_list_is_built_anew(spark, root):
    load_fixture(spark, root, wells=[*WELL_ROWS, ("9", *WELL_ROWS[0][1:])])
    assert monthly.transform(spark, root, now=NOW).dim_pozo.count() == 4
    load_fixture(spark, root, at=datetime(2024, 4, 1))
    assert monthly.transform(spark, root, now=NOW).dim_pozo.count() == 3


def test_profiles_are_kept_per_load(spark, root):
    """Estimates within the stated error of exact counts; only new loads are read."""
    def some(n, low=0):
        return text_frame(spark, ["id", "blank", "few"], [(str(i), "", str(i % 7)) for i in range(low, low + n)])

    exact = {"id": 30000, "blank": 1, "few": 7}
    load(some(20000), root, "r", "2024-01", datetime(2024, 1, 1))
    bronze_profile(spark, root, "r")
    first = current(spark, root).parts("profiles/r")["_load_period=2024-01"]
    load(some(15000, 15000), root, "r", "2024-02", datetime(2024, 2, 1))
    for _ in range(2):
        found = {r.column_name: r for r in bronze_profile(spark, root, "r").collect()}
        assert {c: (r.rows, r.null_count) for c, r in found.items()} == dict.fromkeys(exact, (35000, 0))
        assert all(abs(found[c].distinct_count - n) <= DISTINCT_ERROR * n for c, n in exact.items())
    assert current(spark, root).parts("profiles/r")["_load_period=2024-01"] == first
    load(some(10), root, "r", "2024-01", datetime(2024, 3, 1))
    assert {r.rows for r in bronze_profile(spark, root, "r").collect()} == {15010}
    whole = {r.column_name: r.distinct_count for r in column_profile(some(30000), "r").collect()}
    assert all(abs(whole[c] - n) <= DISTINCT_ERROR * n for c, n in exact.items())


def test_closed_months_without_a_load(spark, root):
    assert monthly.closed_periods(spark, root, date(2026, 1, 31)) == []
    assert monthly.closed_periods(spark, root, date(2026, 3, 1)) == ["2026-01-01", "2026-02-01"]
    load_fixture(spark, root, "2026-01-01")
    load(production(spark, {}), root, "produccion_raw", "2026-02-01", datetime(2026, 3, 1))
    assert monthly.closed_periods(spark, root, date(2026, 4, 1)) == ["2026-02-01", "2026-03-01"]

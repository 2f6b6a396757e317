"""The written pipeline, its report, and reports over stored tables."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import queries
from comptoir.plans.layers import BRONZE, GOLD, SILVER, register_views
from comptoir.plans.rules import cleaning_report
from comptoir.operators.totals import roll_up
from comptoir.plans import gold, runner as runner_module
from comptoir.plans.runner import Runner, by_client, run_pipeline, size_shuffles
from comptoir.plans.serving import REPORTS
from comptoir.sources.landing import FILES, RAW_FILES, LandingTables, manifest, read_csv, rejects, split_csv
from comptoir.sources.retail_tables import RetailTables
from conftest import final_plan
from comptoir.sources.stores import TableStore, _hadoop, intermediates, run_folder, written


CLEANED: dict = {}


@pytest.fixture(scope="module")
def done(spark, folder, tmp_path_factory):
    """Driver tables written as CSV landing files, then the whole pipeline."""
    base = tmp_path_factory.mktemp("pipeline")
    source = RetailTables(spark, folder)
    for name in BRONZE:
        getattr(source, name)().write.option("header", True).csv(f"{base}/landing/{FILES[name]}")
    store = TableStore(spark, root=f"{base}/tables", database_prefix="t_")
    runner = run_pipeline(LandingTables(spark, f"{base}/landing"), store)
    CLEANED[f"{base}/landing"] = runner.cleaning().collect()
    return store, runner.report(), f"{base}/landing"


def test_report_lists_every_table(done):
    _, report, _ = done
    lines = {(r.layer, r.table): r for r in report.collect()}
    assert len(lines) == len(BRONZE) + len(SILVER) + len(GOLD)
    assert {r.status for r in lines.values()} == {"OK"}, [r for r in lines.values() if r.status != "OK"]


def test_row_counts_are_taken_during_the_write(done):
    store, report, _ = done
    for line in report.collect():
        assert store.read(line.layer, line.table).count() == line.rows


def test_cleaning_is_observed_during_the_write(done, house):
    """The same counts as in the query, which has a twin; here they come from the jobs that wrote the tables."""
    observed = sorted(map(tuple, CLEANED[done[2]]))
    assert observed == sorted(map(tuple, cleaning_report(house.bronze).collect()))
    assert all(written == read - duplicate - dropped for _, read, duplicate, _, _, dropped, written in observed)


def test_many_returns_change_the_plan_only(spark, done, house, monkeypatch, tmp_path):
    store, _, _ = done
    assert store.bytes("bronze", "retours") > 0 and store.bytes("bronze", "none") == 0
    monkeypatch.setattr(runner_module, "MANY_RETURNS", 0)
    again = Runner(TableStore(spark, root=str(tmp_path), database_prefix="many_"))
    for name in BRONZE:
        again.store.write(store.read("bronze", name), "bronze", name)
    again.silver()
    assert sorted(map(repr, again.store.read("silver", "retours").collect())) == sorted(map(repr, house.silver.retours.collect()))


def test_empty_tables_are_observed(spark, house):
    class Empty:
        def __getattr__(self, name):
            return getattr(house.bronze, name).limit(0)

    assert [tuple(r)[1:] for r in cleaning_report(Empty()).collect()] == [(0,) * 6] * 6


def test_layers_are_stamped(done):
    store, _, _ = done
    bronze = store.read("bronze", "produits", lineage=True).first()
    assert bronze._layer == "bronze" and bronze._ingested_at and bronze._source_file.endswith(".csv")
    assert store.read("silver", "clients", lineage=True).first()._cleaned_at
    assert store.read("gold", "ca_daily", lineage=True).first()._layer == "gold"


def test_tables_are_listed(done):
    store, _, _ = done
    assert {r.tableName for r in store.list("gold").collect()} == {f"gold_{n}" for n in GOLD}


def test_sales_are_partitioned_by_date(done):
    store, _, _ = done
    one_day = store.read("silver", "ventes").where("date_vente = '1998-03-01'")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_vente" in plan


def test_reports_are_the_same_over_stored_and_lazy_tables(done, house):
    store, _, _ = done
    gold = Runner(store).stored("gold")
    for key in ("q_monthly", "q_by_channel", "q_top10_products", "q_rfm_summary", "q_return_top10",
                "q_stock_critical", "q_affinity_top20", "q_exec_long"):
        stored = sorted(map(repr, REPORTS[key](gold).collect()))
        assert stored == sorted(map(repr, REPORTS[key](house.gold).collect())), key


def test_plain_sql_over_views(done, spark):
    store, _, _ = done
    register_views(Runner(store).stored("gold"), GOLD, "gold")
    top = spark.sql("SELECT mois_label FROM gold_ca_monthly ORDER BY ca_total DESC LIMIT 1").collect()
    assert len(top) == 1


def test_a_failing_table_does_not_stop_the_others(spark, folder, tmp_path):
    class Broken(RetailTables):
        def produits(self):
            raise ValueError("no such file")

    runner = Runner(TableStore(spark, root=str(tmp_path), database_prefix="broken_"))
    runner.bronze(Broken(spark, folder))
    runner.silver()
    status = {(r.layer, r.table): r.status for r in runner.report().collect()}
    assert status[("bronze", "produits")] == "FAILED" and status[("silver", "produits")] == "FAILED"
    assert status[("silver", "ventes")] == "FAILED"
    assert status[("bronze", "ventes")] == "OK" and status[("silver", "clients")] == "OK"


def test_write_replaces(spark, tmp_path):
    store = TableStore(spark, root=str(tmp_path), database_prefix="replace_")
    assert store.write(spark.range(5), "silver", "x") == 5
    assert store.write(spark.range(3).withColumnRenamed("id", "other"), "silver", "x") == 3
    assert store.read("silver", "x").columns == ["other"]


def test_csv_types_declared_or_inferred(spark, done):
    _, _, landing = done
    declared = read_csv(spark, f"{landing}/{FILES['ventes']}", "ventes")
    assert dict(declared.dtypes)["montant"] == "decimal(18,2)"
    inferred = read_csv(spark, f"{landing}/{FILES['ventes']}", "ventes", infer=True)
    assert dict(inferred.dtypes)["date_vente"] == "date"
    assert declared.count() == inferred.count()


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    store = TableStore(spark, root=str(tmp_path), database_prefix="keep_")
    store.write(spark.range(5), "silver", "x")
    with pytest.raises(Exception):
        store.write(spark.range(5).selectExpr("raise_error('no') AS id"), "silver", "x")
    assert store.read("silver", "x").count() == 5
    store.write(spark.range(4), "silver", "x")
    assert store.read("silver", "x").count() == 4
    for n in (3, 2):
        store.write(spark.range(n), "silver", "x")
    versions = [p for p in (tmp_path / "silver" / "silver_x").iterdir() if list(p.glob("_SUCCESS"))]
    assert len(versions) == store.KEPT


def test_readers_keep_the_version_they_began_with(spark, tmp_path):
    store = TableStore(spark, root=str(tmp_path), database_prefix="begun_")
    store.write(spark.range(5), "silver", "x")
    begun = store.read("silver", "x")
    store.write(spark.range(7), "silver", "x")
    assert begun.count() == 5 and store.read("silver", "x").count() == 7


def test_sales_stored_by_client_are_not_shuffled(spark, folder, house, tmp_path, conf):
    """With broadcasts off, the roll-up by client and its join read the stored sales without an exchange."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    runner = Runner(TableStore(spark, root=str(tmp_path), database_prefix="bucket_"), {}, by_client(8))
    runner.bronze(RetailTables(spark, folder))
    runner.silver()
    assert runner.report().where("status <> 'OK'").count() == 0
    silver = runner.stored("silver")
    rolled = roll_up(silver.ventes, "client_id").join(silver.clients, "client_id", "left")
    plan = final_plan(rolled)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    basket = final_plan(gold.customer_basket(silver.ventes, silver.clients))
    assert "SortMergeJoin" in basket and "Exchange" not in basket
    for build in (gold.customer_basket, gold.sales_by_region):
        assert sorted(map(repr, build(silver.ventes, silver.clients).collect())) == sorted(
            map(repr, build(house.silver.ventes, house.silver.clients).collect()))
    files = {p.name.split("_")[-1] for p in tmp_path.glob("silver/silver_ventes/*/part-*.parquet")}
    assert len(files) == len(list(tmp_path.glob("silver/silver_ventes/*/part-*.parquet"))) == 8
    # Replaced by a table without buckets and back.
    runner.store.write(silver.clients, "silver", "clients")
    assert runner.store.read("silver", "clients").count() == house.silver.clients.count()
    with pytest.raises(ValueError):
        runner.store.write(silver.clients, "silver", "x", "ville", bucket_by=("client_id", 2))


class Stop(Exception):
    pass


def stopping_at(store, monkeypatch, step: int):
    """Every statement and file operation of the store counts as a step; one of them fails."""
    taken = iter(range(10_000))

    def counted(name):
        method = getattr(type(store), name)

        def call(*arguments, **options):
            if next(taken) == step:
                raise Stop(name)
            return method(store, *arguments, **options)

        monkeypatch.setattr(store, name, call)

    for name in ("_stage", "_commit", "_point", "_create", "_location", "_load", "_forget_old", "create_database"):
        counted(name)


@pytest.mark.parametrize("partition_by", [None, "p"])
def test_a_failure_at_any_step_leaves_a_whole_set(spark, tmp_path, partition_by):
    """The set is the old or the new one, never a mixture, and recovery brings the catalog to it."""
    rows = lambda n: spark.range(n).selectExpr("id", "id % 2 AS p")
    seen = set()
    for step in range(60):
        store = TableStore(spark, root=f"{tmp_path}/{step}", database_prefix=f"set_{partition_by or ''}{step}_")
        with store.publishing():
            for name in ("a", "b"):
                store.write(rows(10), "silver", name, partition_by)
        with pytest.MonkeyPatch.context() as patch:
            stopping_at(store, patch, step)
            try:
                with store.publishing():
                    store.write(rows(20), "silver", "a", partition_by)
                    store.write(rows(20).withColumnRenamed("id", "other"), "silver", "b", partition_by)
                failed = False
            except Stop:
                failed = True
        again = TableStore(spark, root=store.root, database_prefix=store._prefix)
        sizes = {again.snapshot("silver", name).count() for name in ("a", "b")}
        assert len(sizes) == 1
        assert all(again.read("silver", name).count() in (10, 20) for name in ("a", "b"))
        again.recover()
        assert {again.read("silver", name).count() for name in ("a", "b")} == sizes
        seen |= sizes
        spark.sql(f"DROP DATABASE {store.database('silver')} CASCADE")
        if not failed:
            break
    assert not failed and seen == {10, 20}


def test_tables_of_a_broken_publish_outlive_the_next_ones(spark, tmp_path):
    store = TableStore(spark, root=str(tmp_path), database_prefix="next_")
    with store.publishing():
        for name in ("a", "b"):
            store.write(spark.range(10), "silver", name)
    with pytest.MonkeyPatch.context() as patch:
        point = store._point
        patch.setattr(store, "_point", lambda layer, name, entry: point(layer, name, entry) if name == "a" else (_ for _ in ()).throw(Stop()))
        with pytest.raises(Stop), store.publishing():
            for name in ("a", "b"):
                store.write(spark.range(20), "silver", name)
    assert store.read("silver", "b").count() == 10 and store.snapshot("silver", "b").count() == 20
    for n in (30, 31, 32):
        store.write(spark.range(n), "silver", "a")
        assert (store.read("silver", "a").count(), store.read("silver", "b").count()) == (n, 20)


def test_intermediates_go_with_their_block(spark, house):
    def left(folder):
        files, place = _hadoop(spark, folder)
        return files.exists(place)

    for key in ("agg_quartiles", "gold_product_affinity", "gold_client_rfm", "src_csv_roundtrip"):
        with intermediates(spark) as folder:
            queries()[key](spark, os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")).collect()
            assert left(folder), key
        assert not left(folder)
    with pytest.raises(Stop), intermediates(spark) as folder:
        written(spark.range(3), "lost")
        raise Stop
    assert not left(folder)


def test_a_run_leaves_no_intermediates(spark, folder, tmp_path):
    class Broken(RetailTables):
        def stocks(self):
            raise ValueError("no such file")

    def stored():
        files, place = _hadoop(spark, run_folder(spark))
        return {f.getPath().getName() for f in files.listStatus(place)} if files.exists(place) else set()

    before = stored()
    report = run_pipeline(Broken(spark, folder), TableStore(spark, root=str(tmp_path), database_prefix="left_")).report()
    assert {r.table for r in report.where("status <> 'OK'").collect()} == {"stocks", "stock_alert"}
    assert stored() == before


def landed(tmp_path, name, *lines):
    (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
    (tmp_path / name).write_text("\n".join(lines) + "\n")
    return str(tmp_path / name)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = landed(tmp_path, "retours.csv", "vente_id,note,retour_id,date_retour,motif,produit_id", "5,x,9,2024-02-03,autre,7")
    row = read_csv(spark, path, "retours").first()
    assert (row.retour_id, row.vente_id, row.produit_id, row.motif, str(row.date_retour)) == (9, 5, 7, "autre", "2024-02-03")
    missing = landed(tmp_path, "short.csv", "vente_id,motif", "5,autre")
    with pytest.raises(ValueError, match="retour_id"):
        read_csv(spark, missing, "retours")


def test_whole_numbers_with_a_point_are_kept_and_bad_cells_counted(spark, tmp_path):
    path = landed(
        tmp_path, "ventes.csv", "vente_id,date_vente,client_id,produit_id,canal_id,quantite,montant",
        "1,2024-01-01,5.0,7,1,4.0,9.50", "2,2024-01-01,,7,1,4.5,x", "3,yesterday,6,7", "9007199254740993.0,2024-01-01,1,1,1,1,1")
    rows = read_csv(spark, path, "ventes").orderBy("vente_id").collect()
    assert [(r.vente_id, r.client_id, r.quantite) for r in rows] == [(1, 5, 4), (2, None, None), (3, 6, None), (9007199254740993, 1, 1)]
    counts = {r.column: r.n for r in rejects(spark, path, "ventes").collect()}
    assert counts == {"vente_id": 0, "date_vente": 1, "client_id": 0, "produit_id": 0, "canal_id": 0, "quantite": 1, "montant": 1}


LINES = {
    "1,web,a": None, '2,"a, b",c': None, "3,,": None, '4,"say \\"x\\"",c': None, "5,un\"mid,c": None, '13,un"mid,"x"': None, '14,"ab"c,d': None, ' 6 , x ,"" ': None,
    "7,store,b,EXTRA": "more cells than the header", "8": "fewer cells than the header", "9,x": "fewer cells than the header",
    '10,"open,c': "broken quote", '11,ok,"open': "broken quote", '12,"a\\",b': "broken quote", ",,,": "more cells than the header",
}


def test_lines_that_are_no_records_are_set_aside(spark, tmp_path):
    """Every line but blank ones is accepted or quarantined, the latter as it stands and with its file."""
    header, lines = "canal_id,nom,note", list(LINES)
    landed(tmp_path, "canaux.csv/a.csv", header, *lines[:8], "", "   ")
    landed(tmp_path, "canaux.csv/b.csv", header, *lines[8:])
    accepted, bad = split_csv(spark, str(tmp_path / "canaux.csv"), "canaux")
    assert {r.line: r.reason for r in bad.collect()} == {line: why for line, why in LINES.items() if why}
    assert {(r.table, r.file) for r in bad.collect()} == {("canaux", "b.csv")}
    rows = {r.canal_id: r.nom for r in accepted.collect()}
    assert rows == {1: "web", 2: "a, b", 3: None, 4: 'say "x"', 5: 'un"mid', 6: " x ", 13: 'un"mid', 14: '"ab"c'}
    assert accepted.count() + bad.count() == len(LINES)
    tables = LandingTables(spark, str(tmp_path), {"canaux": "canaux.csv"}, quarantine=True)
    assert tables.canaux().count() == 8 and tables.quarantined().count() == 7
    assert {r._source_file for r in tables.canaux().collect()} == {"a.csv"}


def test_a_later_file_with_another_header_is_no_quarantine(spark, tmp_path):
    landed(tmp_path, "canaux.csv/a.csv", "canal_id,nom", "1,web")
    landed(tmp_path, "canaux.csv/b.csv", "nom,canal_id", "web,1")
    with pytest.raises(Exception, match="(?i)header"):
        split_csv(spark, str(tmp_path / "canaux.csv"), "canaux")[1].collect()


def test_the_pipeline_keeps_a_quarantine_table(spark, folder, tmp_path):
    source = RetailTables(spark, folder)
    for name in BRONZE:
        getattr(source, name)().write.option("header", True).csv(f"{tmp_path}/landing/{FILES[name]}")
    (tmp_path / "landing" / FILES["canaux"] / "more.csv").write_text("canal_id,nom\n77,x,y\n78\n79,z\n")
    store = TableStore(spark, root=f"{tmp_path}/tables", database_prefix="q_")
    runner = Runner(store)
    runner.bronze(LandingTables(spark, f"{tmp_path}/landing", quarantine=True))
    assert {r.line for r in store.read("bronze", "quarantine").collect()} == {"77,x,y", "78"}
    status = {(r.layer, r.table): (r.status, r.rows) for r in runner.report().collect()}
    assert status[("bronze", "quarantine")] == ("OK", 2)
    assert store.read("bronze", "canaux").where("canal_id >= 77").count() == 1


def test_bad_cells_are_counted_while_bronze_is_written(spark, folder, tmp_path):
    source = RetailTables(spark, folder)
    for name in BRONZE:
        getattr(source, name)().write.option("header", True).csv(f"{tmp_path}/landing/{FILES[name]}")
    header = ",".join(f.name for f in source.ventes().schema)
    (tmp_path / "landing" / FILES["ventes"] / "more.csv").write_text(f"{header}\n1,yesterday,2,3,4,five,6\n2,,x,,,,1.5\n")
    landing = LandingTables(spark, f"{tmp_path}/landing")
    runner = Runner(TableStore(spark, root=f"{tmp_path}/tables", database_prefix="cells_"))
    runner.bronze(landing)
    counted = {(r.table, r.column): r.n for r in runner.rejects().collect()}
    assert {k: n for k, n in counted.items() if n} == {("ventes", "date_vente"): 1, ("ventes", "quantite"): 1, ("ventes", "client_id"): 1}
    assert counted == {(r.table, r.column): r.n for r in landing.rejects().collect()}


def test_a_later_file_with_another_header_is_an_error(spark, tmp_path):
    landed(tmp_path, "canaux.csv/a.csv", "canal_id,nom", "1,web")
    landed(tmp_path, "canaux.csv/b.csv", "nom,canal_id", "web,1")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path / "canaux.csv"), "canaux").collect()


def test_files_by_table(spark, tmp_path):
    landed(tmp_path, "raw/canaux/canaux.csv", "canal_id,nom", "1,web")
    row = LandingTables(spark, str(tmp_path), RAW_FILES).canaux().first()
    assert (row.canal_id, row.nom, row._source_file) == (1, "web", "canaux.csv")


def test_manifest_wants_the_exact_place(spark, tmp_path):
    landed(tmp_path, "old/ventes.csv", "vente_id", "1")
    landed(tmp_path, "canaux.csv", "canal_id,nom", "1,web")
    found = {r.file: r.found for r in manifest(spark, str(tmp_path), FILES).collect()}
    assert found["ventes.csv"] is False and found["canaux.csv"] is True


def test_schemas_are_listed(done):
    store, _, _ = done
    assert {"t_bronze", "t_silver", "t_gold"} <= {r.namespace for r in store.schemas().collect()}


def test_manifest_reports_missing_files(spark, done):
    _, _, landing = done
    expected = {**FILES, "promos": "promos.csv"}
    found = {r.file: (r.destination, r.found, r.n) for r in manifest(spark, landing, expected).collect()}
    assert found["promos.csv"] == ("raw/promos/promos.csv", False, 0)
    assert found["canaux.csv"][:2] == ("raw/canaux/canaux.csv", True)
    assert found["canaux.csv"][2] == read_csv(spark, f"{landing}/canaux.csv", "canaux").count()


def test_shuffle_partitions_follow_the_input(spark, conf):
    conf("spark.sql.shuffle.partitions", "8")
    assert size_shuffles(spark, 1000) == spark.sparkContext.defaultParallelism
    assert size_shuffles(spark, 100 * 1024**3) == 800
    assert size_shuffles(spark, 100 * 1024**4) == 819_200


def test_counted_tables_are_not_dealt_out_again(spark, folder, monkeypatch):
    """The tables of catalog_tables go as soon as they are counted, so their files need not be even."""
    monkeypatch.setattr("comptoir.sources.stores.balanced", None)
    assert {r.table for r in queries()["catalog_tables"](spark, folder).collect()} == {f"silver_{name}" for name in SILVER}


def test_cleaning_report_evaluates_no_lookups(spark, house, monkeypatch):
    """Rows are counted, and no whole table is written to be forgotten."""
    expected = {name: house.silver[name].count() for name in SILVER}
    monkeypatch.setattr(type(spark.range(1)), "write", None)
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, lines, schema: lines)
    assert {line[0]: line[-1] for line in cleaning_report(house.bronze)} == expected

from __future__ import annotations

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrameWriter

from fieldbook.plans import survey
from fieldbook.plans.preparation import prepare
from fieldbook.sources import runs, tables
from fieldbook.sources.ingest import _publish, ingest
from fieldbook.sources.spec import SourceSpec, text_schema
from workload.bindings import delivered, lines

COLUMNS = ["home", "person", "pay"]
CSV = 'home,person,pay,extra\n1,1, 1 ,z\n 2 ,1,"1,200",z\n3,"",,z\n'


def source(tmp_path, period="2025T1", text=CSV, rows=3, columns=4):
    path = tmp_path / f"{period}.csv"
    path.write_text(text, encoding="utf-8")
    return SourceSpec(
        str(path), period, rows, columns, provenance={"file_year": 2025, "calendar_quarter": 1}
    )


def test_ingest_checks_trims_and_records_provenance(spark, tmp_path):
    root = str(tmp_path / "store")
    specs = [source(tmp_path, p) for p in ("2025T2", "2025T1")]
    audit = ingest(spark, specs, COLUMNS, root).collect()
    assert [tuple(r) for r in audit] == [
        ("2025T1", "2025T1.csv", 3, 3, "converted"),
        ("2025T2", "2025T2.csv", 3, 3, "converted"),
    ]
    table = tables.load_periods(spark, root, ["2025T1"])
    assert dict(table.dtypes) == {
        "home": "string", "person": "string", "pay": "string", "source_file": "string",
        "file_year": "int", "calendar_quarter": "int", "period": "string",
    }
    rows = {r["home"]: r for r in table.collect()}
    assert set(rows) == {"1", "2", "3"}
    assert rows["2"]["pay"] == "1,200" and rows["2"]["period"] == "2025T1"
    assert rows["3"]["person"] == "" and rows["3"]["pay"] is None
    assert tables.load_periods(spark, root, ["2025T1", "2025T2"]).count() == 6
    again = ingest(spark, specs, COLUMNS, root).collect()
    assert {r["state"] for r in again} == {"reused"}
    forced = ingest(spark, specs[:1], COLUMNS, root, force=True).first()
    assert forced["state"] == "converted"


@pytest.mark.parametrize(
    ("change", "message"),
    [
        ({"rows": 4}, "3 rows, expected 4"),
        ({"columns": 5}, "4 columns, expected 5"),
        ({"text": "home,person\n1,1\n"}, "missing columns"),
    ],
)
def test_a_broken_contract_publishes_nothing(spark, tmp_path, change, message):
    root = str(tmp_path / "store")
    with pytest.raises(ValueError, match=message):
        ingest(spark, [source(tmp_path, **change)], COLUMNS, root)
    assert not (tmp_path / "store" / "period=2025T1").exists()


def test_a_failed_refresh_keeps_the_published_data(spark, tmp_path):
    root = str(tmp_path / "store")
    ingest(spark, [source(tmp_path)], COLUMNS, root)
    with pytest.raises(ValueError):
        ingest(spark, [source(tmp_path, text="home,person,pay,extra\n9,9,9,9\n")], COLUMNS, root, force=True)
    assert tables.load_periods(spark, root, ["2025T1"]).count() == 3


def test_a_rename_that_fails_keeps_the_published_data(spark, tmp_path):
    root = str(tmp_path / "store")
    ingest(spark, [source(tmp_path)], COLUMNS, root)
    with pytest.raises((OSError, Py4JJavaError)):
        _publish(spark, str(tmp_path / "nothing"), f"{root}/period=2025T1")
    assert tables.load_periods(spark, root, ["2025T1"]).count() == 3


def test_reused_data_is_held_to_the_contract(spark, tmp_path):
    root = str(tmp_path / "store")
    ingest(spark, [source(tmp_path)], COLUMNS, root)
    with pytest.raises(ValueError, match="expected 7"):
        ingest(spark, [source(tmp_path, rows=7)], COLUMNS, root)


def test_missing_source_and_empty_period_list(spark, tmp_path):
    spec = SourceSpec(str(tmp_path / "none.csv"), "p", 1, 1)
    with pytest.raises(FileNotFoundError):
        ingest(spark, [spec], COLUMNS, str(tmp_path))
    with pytest.raises(ValueError):
        tables.load_periods(spark, str(tmp_path), [])
    with pytest.raises(ValueError):
        tables.union_by_name([])


def test_parquet_sources_are_held_to_the_same_contract(spark, tmp_path):
    path = str(tmp_path / "p.parquet")
    spark.createDataFrame([(1, " a ", 2.5)], "home int, person string, pay double").write.parquet(path)
    spec = SourceSpec(path, "p", 1, 3, format="parquet")
    ingest(spark, [spec], COLUMNS, str(tmp_path / "store"))
    row = tables.load_periods(spark, str(tmp_path / "store"), ["p"]).first()
    assert (row["home"], row["person"], row["pay"]) == ("1", "a", "2.5")


def test_only_the_chosen_period_folders_are_read(spark, tmp_path):
    root = str(tmp_path / "t")
    frame = spark.createDataFrame([("2025", 1), ("2026", 2)], "period string, v int")
    tables.write_by_period(frame, root)
    chosen = tables.load_periods(spark, root, ["2026"])
    assert [tuple(r) for r in chosen.select("period", "v").collect()] == [("2026", 2)]
    assert all("period=2026" in name for name in chosen.inputFiles())


def test_predictions_need_their_columns(spark, tmp_path):
    path = str(tmp_path / "p")
    stored = tables.materialise(spark.range(3), path)
    assert stored.count() == 3
    with pytest.raises(ValueError, match="missing columns"):
        tables.read_predictions(spark, path, ["id", "prediction"])
    assert tables.read_predictions(spark, path, ["id"]).count() == 3


def test_steps_lie_in_the_run_folder_and_are_listed(spark, tmp_path, monkeypatch):
    assert runs.shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    with monkeypatch.context() as patched:
        patched.setattr(runs, "shared_root", lambda spark: str(tmp_path))
        path = runs.scratch_path(spark, "x")
        assert path.startswith(f"{tmp_path}/run-{spark.sparkContext.applicationId}/x-")
        kept = tables.materialise(spark.range(5), name="five")
        assert kept.count() == 5
        assert [step["name"] for step in runs.steps(spark)] == ["x", "five"]
        left = tmp_path / "run-lost" / "_manifest"
        left.mkdir(parents=True)
        (left / "a.json").write_text('{"name": "a", "path": "p", "started": 1.0}')
        (tmp_path / "other").mkdir()
        assert [folder.rsplit("/", 1)[-1] for folder in runs.abandoned_runs(spark, 60)] == ["run-lost"]
        runs.end_run(spark, runs.abandoned_runs(spark, 60)[0])
        runs.end_run(spark)
        assert [entry.name for entry in tmp_path.iterdir()] == ["other"]


def test_a_cluster_has_to_name_the_shared_folder(spark):
    class Elsewhere:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        runs.shared_root(Elsewhere())


def test_result_tables_are_csv_with_a_header_and_come_back(spark, tmp_path):
    path = str(tmp_path / "r")
    schema = "name string, n long, share double, ok boolean"
    rows = [("a, \"b\"", 1, 0.1 + 0.2, True), ("", None, None, None), (None, 3, float("inf"), False)]
    tables.write_result_table(spark.createDataFrame(rows, schema), path)
    assert spark.read.option("header", "true").csv(path).columns == ["name", "n", "share", "ok"]
    back = tables.read_result_table(spark, path, schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
    with pytest.raises(Exception, match="(?i)header|schema"):
        tables.read_result_table(spark, path, "title string, n long, share double, ok boolean").collect()
    with pytest.raises(Exception, match="(?i)malformed|cannot parse|failfast"):
        tables.read_result_table(spark, path, "name long, n long, share double, ok boolean").collect()


def test_one_broken_source_publishes_none_of_the_others(spark, tmp_path):
    root = str(tmp_path / "store")
    good, short = source(tmp_path, "2025T1"), source(tmp_path, "2025T2", rows=2)
    with pytest.raises(ValueError, match="2025T2.csv: 3 rows, expected 2"):
        ingest(spark, [good, short], COLUMNS, root)
    assert not (tmp_path / "store" / "period=2025T1").exists()
    with pytest.raises(ValueError, match="repeat"):
        ingest(spark, [good, good], COLUMNS, root)
    empty = source(tmp_path, "2025T3", text="home,person,pay,extra\n", rows=0)
    audit = ingest(spark, [good, empty], COLUMNS, root).collect()
    assert [(r["period"], r["rows"]) for r in audit] == [("2025T1", 3), ("2025T3", 0)]
    assert ingest(spark, [], COLUMNS, root).count() == 0


def test_columns_of_all_sources_are_checked_before_any_is_converted(spark, tmp_path):
    root = tmp_path / "store"
    good, narrow = source(tmp_path, "2025T1"), source(tmp_path, "2025T2", columns=5)
    with pytest.raises(ValueError, match="2025T2.csv: 4 columns, expected 5"):
        ingest(spark, [good, narrow], COLUMNS, str(root))
    assert not root.exists()


def test_every_period_is_counted_whatever_its_name(spark, tmp_path):
    root = str(tmp_path / "store")
    names = ["2025T1", "half year", "2025%3A1"]
    specs = [source(tmp_path, name, CSV + "4,1,5,z\n" * i, 3 + i) for i, name in enumerate(names)]
    for state in ("converted", "reused"):
        audit = {r["period"]: (r["rows"], r["state"]) for r in ingest(spark, specs, COLUMNS, root).collect()}
        assert audit == {name: (3 + i, state) for i, name in enumerate(names)}


def test_sources_are_gathered_before_they_are_text(spark, tmp_path, monkeypatch):
    """Text is wider than the columns it is made from, which are all that is shuffled by period."""
    sf_dir, plans = "/root/testdata/sf0.001", []
    write = DataFrameWriter.csv

    def spy(self, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "csv", spy)
    specs = delivered(spark, sf_dir)
    plan = plans[0]
    assert plan.index(" AS age_txt") < plan.index("RebalancePartitions") < plan.index("Join")
    found = spark.read.option("header", "true").csv([spec.path for spec in specs])
    assert found.count() == sum(spec.expected_rows for spec in specs) == lines(spark, sf_dir).count()
    assert {len(found.columns)} == {spec.expected_columns for spec in specs}


def test_survey_contract():
    assert list(survey.PERIODS) == ["2025T1", "2025T2", "2025T3", "2025T4", "2026T1"]
    assert [p[2] for p in survey.PERIODS.values()] == [51588, 51167, 51583, 49338, 49843]
    assert [p[3] for p in survey.PERIODS.values()] == [270, 270, 270, 302, 270]
    assert {"NUM_HOGAR", "NUM_PERSONA", "FACTOR", "ANIO", "TRIMESTRE"} <= set(survey.SOURCE_COLUMNS)
    assert len(survey.SOURCE_COLUMNS) == 14
    assert len(survey.FEATURES.predictors) == 6
    held_out = {survey.FEATURES.label, "weight", "cluster", "period", *survey.SOURCE_COLUMNS}
    assert not held_out & set(survey.FEATURES.predictors)
    assert set(survey.SPLIT.train) | set(survey.SPLIT.validation) | set(survey.SPLIT.test) == set(survey.PERIODS)
    assert [spec.file_name for spec in survey.sources("/data")][0] == "2025T1.csv"


def test_survey_records_from_text_to_prepared_table(spark, tmp_path):
    def person(number, **changes):
        record = dict.fromkeys(survey.SOURCE_COLUMNS, "1")
        record.update(
            NUM_PERSONA=str(number), P02A03="30", P05D01="3,500", P05C07A="2", P05C07B="6",
            P05H01A="40", P03A03A="0", P05C16="2.0", DOMINIO="3", TRIMESTRE="2",
        )
        record.update(changes)
        return tuple(record.values())

    people = [
        person(1),
        person(2, P02A03="14"),
        person(3, OCUPADOS=None),
        person(4, P05C16="5"),
        person(5, P05D01="NA"),
        person(6, P05C07B="12"),
        person(7, P05C07A="31"),
        person(8, P05H01A="169"),
        person(9, P05H01A="168", P05C07B="0"),
    ]
    raw = spark.createDataFrame(people, text_schema(survey.SOURCE_COLUMNS)).selectExpr("*", "'2025T1' AS period")
    done = prepare(raw, survey.RULES, survey.eligibility(), survey.KEYS, "period", survey.SOURCE_COLUMNS)
    assert [r["after"] for r in done.funnel.collect()] == [9, 8, 7, 6, 5, 4, 3, 2]
    lazily = done.eligible.select("NUM_PERSONA", "monthly_pay", "education", "area", "tenure")
    assert [tuple(r) for r in lazily.orderBy("NUM_PERSONA").collect()] == [
        ("1", 3500.0, "Ninguno", "Rural Nacional", 2.5),
        ("9", 3500.0, "Ninguno", "Rural Nacional", 2.0),
    ]
    assert done.by_period.first()["after"] == 2
    assert done.missing.first()["variable"] == "OCUPADOS"
    assert done.duplicates.first()["duplicate_groups"] == 0
    audit = done.write(str(tmp_path / "prepared"))
    assert [tuple(r) for r in audit.collect()] == [tuple(r) for r in done.funnel.collect()]
    assert tables.load_periods(spark, str(tmp_path / "prepared"), ["2025T1"]).count() == 2

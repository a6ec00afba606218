import json

import pytest

from riskloom.sources.lookup import build_scenarios, form_overrides, lookup_entities, to_json_records
from riskloom.sources.tables import Database, TableLoader, create_database


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        TableLoader(spark, str(tmp_path)).load("nope.csv")


def test_load_all_skips_absent_tables(spark, tmp_path):
    (tmp_path / "application_train.csv").write_text("SK_ID_CURR,TARGET,AMT_CREDIT\n1,0,10.5\n2,1,\n")
    loader = TableLoader(spark, str(tmp_path))
    tables = loader.load_all()
    assert list(tables) == ["application_train"]
    assert [tuple(r) for r in loader.load_train().orderBy("SK_ID_CURR").collect()] == [(1, 0, 10.5), (2, 1, None)]
    assert spark.sql("SELECT count(*) FROM application_train").first()[0] == 2


def test_database_names_columns_sql_and_cache(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, s string")
    path = str(tmp_path / "db")
    create_database({"first_t": df, "second_t": df}, path)
    create_database({"first_t": df.where("id = 1")}, path)
    db = Database(spark, path)
    assert db.table_names() == ["first_t", "second_t"]
    assert db.columns("first_t") == ["id", "s"]
    assert db.read_table("first_t").count() == 1
    with pytest.raises(ValueError):
        db.read_table("third")
    sql = "SELECT s FROM second_t WHERE id = :id"
    assert db.execute_query(sql, {"id": 2}, "k").first()[0] == "b"
    assert db.execute_query(sql, {"id": 1}, "k").first()[0] == "a"
    assert db.execute_query(sql, {"id": 2}, "k").first()[0] == "b"
    assert db.clear_cache() == 2
    assert db.clear_cache() == 0


def test_lookup_prefers_train_as_a_whole_row(spark):
    train = spark.createDataFrame([(1, "t1", None), (2, "t2", 5)], "id long, s string, v int")
    test = spark.createDataFrame([(1, "x1", 9), (3, "x3", 7)], "id long, s string, w int")
    asked = spark.createDataFrame([(1,), (3,), (4,), (1,)], "id long")
    got = {r["id"]: (r["s"], r["v"], r["w"], r["found_in"]) for r in lookup_entities(asked, train, test, "id").collect()}
    assert got == {1: ("t1", None, None, "train"), 3: ("x3", None, 7, "test"), 4: (None, None, None, None)}


def test_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, 2.5)], "id long, s string, v double")
    assert json.loads(to_json_records(df, "id").first()["record"]) == {"id": 1, "s": None, "v": 2.5}


def test_scenarios_ignore_unknown_and_leave_the_rest_null(spark):
    template = spark.createDataFrame([], "AMT_CREDIT double, AMT_INCOME_TOTAL double, AMT_ANNUITY double, DAYS_BIRTH double, DAYS_EMPLOYED double, NAME string")
    over = spark.createDataFrame([("a", "AMT_CREDIT", "50"), ("a", "AMT_INCOME_TOTAL", "5"), ("a", "BAD", "1")], "scenario_id string, feature string, value string")
    row = build_scenarios(over, template).first()
    assert row["CREDIT_INCOME_PERCENT"] == 10.0 and row["NAME"] is None and row["CREDIT_TERM"] is None
    assert "BAD" not in row.asDict()


def test_scenarios_on_a_base_row_may_set_null(spark):
    base = spark.createDataFrame([("a", 1.0, "x")], "sid string, p double, q string")
    over = spark.createDataFrame([("a", "p", None)], "scenario_id string, feature string, value string")
    row = build_scenarios(over, base.drop("sid"), base, "sid", with_ratios=False).first()
    assert row["p"] is None and row["q"] == "x"


def test_form_years_become_negative_days(spark):
    forms = spark.createDataFrame(
        [("a", "AGE_YEARS", "40"), ("a", "EMPLOYED_YEARS", "0"), ("a", "CNT_CHILDREN", "4")], "scenario_id string, feature string, value string"
    )
    got = {r["feature"]: r["value"] for r in form_overrides(forms).collect()}
    assert float(got["DAYS_BIRTH"]) == -14610.0
    assert got["DAYS_EMPLOYED"] is None and got["CNT_CHILDREN"] == "0" and got["SK_ID_CURR"] == "999999"


def test_scratch_tables_go_with_their_block(spark):
    import os

    from riskloom.functions.session import materialise, scratch, work_dir

    with scratch(spark):
        df = materialise(spark.range(3).toDF("x"), "scratch_test")
        assert df.count() == 3
        (path,) = {os.path.dirname(f).removeprefix("file://") for f in df.inputFiles()}
        assert os.path.isdir(path)
    assert not os.path.exists(path)
    assert materialise(spark.range(2).toDF("x"), "kept").count() == 2 and work_dir(spark)


def test_a_rewritten_table_is_queried_anew(spark, tmp_path):
    from riskloom.sources.tables import Database, create_database

    path = str(tmp_path / "db2")
    create_database({"t": spark.range(2).toDF("x")}, path)
    sql = "SELECT count(*) AS n FROM t"
    assert Database(spark, path).execute_query(sql, cache_key="n").first()["n"] == 2
    create_database({"t": spark.range(5).toDF("x")}, path)
    again = Database(spark, path)
    assert again.execute_query(sql, cache_key="n").first()["n"] == 5
    assert again.clear_cache() == 2 and Database(spark, path).clear_cache() == 0


def test_two_writers_get_versions_of_their_own(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from riskloom.operators.registry import ModelRegistry

    kept = ModelRegistry(spark, str(tmp_path / "registry"))
    kept.log_run("e", "r")

    def work(_):
        return [ModelRegistry(spark, kept.path).register_best("e", "r", "m") for _ in range(6)]

    with ThreadPoolExecutor(2) as pool:
        got = [v for versions in pool.map(work, range(2)) for v in versions]
    assert sorted(got) == list(range(1, 13))
    assert sorted(r["version"] for r in kept.events().collect()) == list(range(1, 13))


def test_blanks_in_literals_are_told_apart(spark, tmp_path):
    create_database({"t": spark.range(1)}, f"{tmp_path}/db")
    db = Database(spark, f"{tmp_path}/db")
    got = [db.execute_query(f"SELECT '{x}' AS v FROM t", cache_key="k").first()["v"] for x in ("a b", "a  b")]
    assert got == ["a b", "a  b"]


def test_claims_of_many_threads_are_distinct(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from riskloom.operators.registry import ModelRegistry

    kept = ModelRegistry(spark, str(tmp_path / "registry"))
    with ThreadPoolExecutor(4) as pool:
        got = [v for versions in pool.map(lambda _: kept._claim("m", 0, 25), range(4)) for v in versions]
    assert sorted(got) == list(range(1, 101))

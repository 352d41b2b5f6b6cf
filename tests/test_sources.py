import pytest

from conftest import rows
from ledgertag import session
from ledgertag.functions.hashing import row_digest
from ledgertag.operators.assemble import long_targets
from ledgertag.sources.tables import Source, TABLES, load_table, load_tables


def csv(tmp_path, *lines):
    path = tmp_path / "table.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_csv_columns_are_found_by_name_and_any_deletion_mark_counts(spark, tmp_path):
    path = csv(
        tmp_path,
        "account_id_hashed,user_id_hashed,extra,site_id,deleted",
        "A1,U1,x,S1,",
        "A2,U2,x,S2,2020-05-01",
    )
    found = load_table(spark, "accounts", path)
    assert found.columns == ["user_id_hashed", "account_id_hashed", "deleted", "site_id"]
    assert rows(found) == [("U1", "A1", None, "S1"), ("U2", "A2", "2020-05-01", "S2")]


def test_missing_columns_and_bad_values_raise(spark, tmp_path):
    with pytest.raises(ValueError, match="country_code"):
        load_table(spark, "users", csv(tmp_path, "user_id_hashed", "U1"))
    names = ",".join(TABLES["transactions"].columns)
    row = "u,a,t,2020-01-01,soon,d,i,debit,1.5,c,u,a,t,1,2020"
    with pytest.raises(Exception, match="pending: not a int: soon"):
        load_table(spark, "transactions", csv(tmp_path, names, row)).collect()


def test_parquet_columns_get_the_declared_types(spark, tmp_path):
    path = str(tmp_path / "feedback")
    spark.createDataFrame(
        [("u", "a", "t", "2020-01-02", "1", "2020-01-03 04:05:06", "General")],
        "user_id string, account_id string, transaction_id string, date string, pending string, "
        "feedback_time string, category string",
    ).write.parquet(path)
    found = load_table(spark, "historical_categories_feedback", path)
    assert [t for _, t in found.dtypes] == ["string"] * 3 + ["date", "int", "timestamp", "string"]
    assert found.first().date.isoformat() == "2020-01-02"


def test_format_and_options_are_given_per_table(spark, tmp_path):
    folder = tmp_path / "users"
    folder.mkdir()
    (folder / "part").write_text("user_id_hashed;country_code\nU1;NL\n")
    source = Source(str(folder), "csv", {"sep": ";"})
    assert rows(load_table(spark, "users", source.path, source.file_format, **source.options)) == [
        ("U1", "NL")
    ]
    with pytest.raises(KeyError, match="test_users"):
        load_tables(spark, {"users": source})


def test_digests_tell_apart_what_separators_would_join(spark):
    df = spark.createDataFrame(
        [("a|b", "c"), ("a", "b|c"), (None, "x"), ("~", "x"), ("", "x"), ("1:a", "x")], "a string, b string"
    )
    assert df.select(row_digest(["a", "b"])).distinct().count() == 6


def test_a_label_given_very_often_is_repeated_in_pieces(spark):
    wide = spark.createDataFrame(
        [(1, "General", [("Rent", 2_500_000)]), (2, "General", None)],
        "id int, target_category string, label_counts array<struct<label: string, copies: bigint>>",
    )
    long = long_targets(wide)
    counts = rows(long.groupBy("id", "target_label").count())
    assert counts == [(1, "General", 1), (1, "Rent", 2_500_000), (2, "General", 1)]


def test_without_a_shared_folder_only_local_mode_works(spark):
    class Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, name, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())

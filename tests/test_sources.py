import datetime
import json

from pyspark.sql import functions as F

from lexiquarry.sources import articles as ar

HEADER = ("cord_uid,sha,source_x,title,doi,pmcid,license,abstract,publish_time,authors,journal,"
          "who_covidence_id,arxiv_id,pdf_json_files,pmc_json_files,url,s2_id")


def write_csv(path):
    lines = [
        HEADER,
        'u1,,PMC,"A ""quoted"", title",,,,"Line one\nline two",2020-1-5,,,,,,,,',
        "u2,,PMC,Plain,,,,,2020,,,,,,,,",
        "u3,,WHO,Third,,,,Text,2020-02-30,,,,,,,,",
    ]
    path.write_text("\n".join(lines) + "\n")


def test_csv_cells_and_dates(spark, tmp_path):
    write_csv(tmp_path / "a.csv")
    rows = ar.read_articles_csv(spark, str(tmp_path / "a.csv"))
    first = rows.where("cord_uid = 'u1'").first()
    assert first.title == 'A "quoted", title'
    assert first.abstract == "Line one\nline two"
    assert first.publish_time == "2020-1-5"
    assert rows.where("cord_uid = 'u2'").first().abstract is None
    dates = {r.cord_uid: r.publish_time for r in ar.validate_dates(rows).collect()}
    assert dates == {"u1": datetime.date(2020, 1, 5), "u2": None, "u3": None}
    rejected = {r.rejected: r.n_rows for r in ar.rejected_dates(rows).collect()}
    assert rejected == {"2020": 1, "2020-02-30": 1}


def test_tail_and_head(spark, tmp_path):
    write_csv(tmp_path / "a.csv")
    rows = ar.read_articles_csv(spark, str(tmp_path / "a.csv"))
    assert [r.cord_uid for r in ar.tail_rows(rows, 2).collect()] == ["u3", "u2"]
    assert [r.cord_uid for r in ar.tail_rows(rows, 2, key="cord_uid").collect()] == ["u3", "u2"]
    assert [r.cord_uid for r in ar.head_rows(rows, 2, key="cord_uid").collect()] == ["u1", "u2"]


def test_typed_table_keeps_search_traits(spark, tmp_path):
    write_csv(tmp_path / "a.csv")
    typed = ar.to_typed(ar.with_processed_copies(ar.read_articles_csv(spark, str(tmp_path / "a.csv"))))
    assert typed.columns == list(ar.ARTICLE_FIELDS)
    assert typed.schema["publish_time"].dataType.simpleString() == "date"
    assert "cord_uid" not in ar.searchable_fields(typed.schema)
    assert typed.schema["pr_title"].metadata["similarity"] == "BM25"
    assert ar.article_schema(date_as_text=True)["publish_time"].dataType.simpleString() == "string"


def test_json_documents(spark, tmp_path):
    write_csv(tmp_path / "a.csv")
    rows = ar.read_articles_csv(spark, str(tmp_path / "a.csv")).select("cord_uid", "title", "abstract")
    found = {r.cord_uid: json.loads(r.document) for r in ar.rows_as_json(rows, "cord_uid").collect()}
    assert found["u2"] == {"cord_uid": "u2", "title": "Plain", "abstract": None}
    ar.write_json_documents(rows, str(tmp_path / "json"))
    ar.write_json_documents(rows, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 3


def test_write_comparison(spark, tmp_path):
    table = spark.createDataFrame([("q1", 1, "a"), ("q2", 1, None)], "query_id string, rank int, x string")
    for form in ("parquet", "json", "csv"):
        ar.write_comparison(table, str(tmp_path / form), form)
        read = spark.read.option("header", True).format(form).load(str(tmp_path / form))
        assert {r.query_id for r in read.collect()} == {"q1", "q2"}


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("pubmed_id,title,cord_uid,mag_id\n7,T,u1,9\n")
    row = ar.read_articles_csv(spark, str(tmp_path / "a.csv")).first()
    assert (row.cord_uid, row.title, row.abstract) == ("u1", "T", None) and "pubmed_id" not in row

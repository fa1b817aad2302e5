from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from support import collected
from ledgerleaf import schemas, session
from ledgerleaf.operators import ledger
from ledgerleaf.sources import export, jdbc, pages
from ledgerleaf.sources.warehouse import Warehouse


@pytest.fixture
def warehouse(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.create_tables()
    return wh


def test_page_files(spark, tmp_path):
    for name, text in (("T-Seite-12.html", "<p>\nzwölf</p>"), ("T.html", "start")):
        (tmp_path / name).write_text(text, encoding="utf-8")
    got = pages.page_files(spark, str(tmp_path), source_id=1, run_id=2)
    assert got.columns == schemas.PAGES.fieldNames()
    assert collected(got.select("source_id", "run_id", "page_number", "html")) == [
        (1, 2, 1, "start"), (1, 2, 12, "<p>\nzwölf</p>"),
    ]


def test_page_table(spark, tmp_path):
    spark.createDataFrame([(1, 1, 1, "u", "h")], schemas.PAGES).write.parquet(str(tmp_path / "p"))
    assert pages.page_table(spark, str(tmp_path / "p")).schema.fieldNames() == schemas.PAGES.fieldNames()


def test_failed_urls(spark, tmp_path):
    lines = ["Page 1: https://x.de/T-Seite-200.html", "Page 200: https://x.de/T-Seite-200.html", "",
             "Page 1: https://x.de/T/Seite-1.html", "Page 1: https://x.de/T/Seite-1.html", "Page 2: https://x.de/T/Seite-2",
             "garbage", "Page 3: https://x.de/T.html"]
    (tmp_path / "failed.txt").write_text("\n".join(lines))
    assert collected(pages.failed_urls(spark, str(tmp_path / "failed.txt"))) == [
        (1, "https://x.de/T-Seite-200.html", True), (1, "https://x.de/T/Seite-1.html", False),
        (2, "https://x.de/T/Seite-2", False), (3, "https://x.de/T.html", False),
        (200, "https://x.de/T-Seite-200.html", False),
    ]


def test_resume(spark, tmp_path, rows):
    (tmp_path / "state.json").write_text('{"last_page": 122}')
    state = pages.progress(spark, str(tmp_path / "state.json"))
    todo = rows("page_number int", (121,), (122,), (123,))
    assert collected(pages.resume_after(todo, state)) == [(123,)]
    assert pages.resume_after(todo, state.limit(0)).count() == 3


def test_tables_are_created_once(warehouse):
    for table in schemas.TABLES:
        assert warehouse.read(table).count() == 0
        assert warehouse.read(table).schema.fieldNames() == [*schemas.TABLES[table].fieldNames(), "batch_id"]
    warehouse.put("listing_pages", warehouse.spark.createDataFrame([(1, "u")], "id bigint, url string"), 0)
    warehouse.create_tables()
    assert warehouse.read("listing_pages").count() == 1


def test_batches_replace_themselves(warehouse, rows):
    one = rows("id bigint, url string, metadata string", (1, "u", "{}"), (2, "v", "{}"))
    warehouse.put("listing_pages", one, 3)
    warehouse.put("listing_pages", one, 3)
    warehouse.put("listing_pages", one.limit(1), 4)
    assert warehouse.read("listing_pages").count() == 3
    assert warehouse.before("listing_pages", 4).count() == 2 and warehouse.batch("listing_pages", 4).count() == 1
    assert warehouse.next_batch("listing_pages") == 5 and warehouse.next_batch("raw_data") == 0
    warehouse.put("listing_pages", one.limit(0), 3)
    assert warehouse.read("listing_pages").count() == 1
    with pytest.raises(ValueError, match="oops"):
        warehouse.put("listing_pages", one.withColumn("oops", F.lit(1)), 5)


def test_truncate_and_reset(warehouse, rows):
    one = rows("id bigint, url string", (1, "u"), (2, "v"))
    for table in ("listing_pages", "website_data"):
        warehouse.put(table, one, 0)
    assert warehouse.truncate("listing_pages") == {"listing_pages": {"before": 2, "after": 0, "deleted": 2}}
    assert warehouse.truncate("listing_pages") == {"listing_pages": {"before": 0, "after": 0, "deleted": 0}}
    assert warehouse.read("website_data").count() == 2
    warehouse.put("listing_pages", one, 0)
    for _ in range(2):
        warehouse.reset()
        assert warehouse.read("listing_pages").count() == 0 and warehouse.read("website_data").count() == 0


def test_views_answer_sql(warehouse):
    spark = warehouse.spark
    warehouse.put("data_sources", ledger.new_sources(
        warehouse.read("data_sources"), spark.createDataFrame([("dir", "https://x.de")], "name string, url string")), 0)
    source = warehouse.read("data_sources").first()
    warehouse.put("run_changes", ledger.open_run(spark, 1, source.id), 0)
    warehouse.put("run_changes", ledger.close_run(spark, 1, 1), 1)
    warehouse.register_views("v_")
    got = spark.sql("""select sr.id, ds.name as source, sr.status from v_scraping_runs sr
                       join v_data_sources ds on sr.source_id = ds.id""")
    assert collected(got) == [(1, "dir", "completed")]


def test_jdbc_options():
    env = {"DB_HOST": "h", "DB_NAME": "n", "DB_USER": "u", "DB_PASSWORD": "p"}
    assert jdbc.options_from_env(env) == {
        "url": "jdbc:postgresql://h:5432/n", "user": "u", "password": "p", "driver": "org.postgresql.Driver",
    }
    assert jdbc.options_from_env({**env, "DB_PORT": "1"})["url"].startswith("jdbc:postgresql://h:1/")
    with pytest.raises(KeyError, match="DB_PASSWORD"):
        jdbc.options_from_env({k: v for k, v in env.items() if k != "DB_PASSWORD"})
    scan = jdbc.scan_options("raw_data", "id", 0, 100, 8)
    assert scan["numPartitions"] == "8" and scan["partitionColumn"] == "id" and scan["dbtable"] == "raw_data"


@pytest.mark.parametrize("fmt", export.FORMATS)
def test_export_round_trip(rows, tmp_path, fmt):
    ddl = "id int, name string, address struct<street: string, city: string>, tags array<string>"
    df = rows(ddl, (1, 'a "q", b\nc', ("S", None), ["x"]), (2, None, None, None), (3, "", ("", ""), []))
    path = str(tmp_path / fmt)
    export.export(df, path, fmt)
    reader = df.sparkSession.read
    if fmt == "csv":
        back = reader.options(multiLine=True, **export.CSV).schema(
            "id int, name string, address string, tags string").csv(path)
        assert back.where("id = 3").first()["name"] == "", back.collect()
        back = back.withColumns({
            "address": F.from_json("address", "struct<street: string, city: string>"),
            "tags": F.from_json("tags", "array<string>"),
        })
    else:
        back = reader.schema(ddl).format(fmt).load(path)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    with pytest.raises(ValueError):
        export.export(df, path, "xlsx")


def test_shared_dir(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")

    class Bare:
        class conf:
            get = staticmethod(lambda key, default: default)

    assert session.shared_dir(Bare, "/shared/") == "/shared"
    with pytest.raises(ValueError):
        session.shared_dir(Bare)

import duckdb

from tickforge.plans import catalog


def test_whole_texts_of_all_documents(spark, tmp_path):
    texts = [" Unknown <7> ", "10.0.0.1:80", "C:\\temp\\x", "/var/log/x", "0x" + "ab" * 20, " CTF ", None, "", "key=https://x", "ab_" * 100, "a" * 256 + " b", "y" * 300 + " https://x", "Text é " * 100]
    texts += [f"text_{k}" for k in range(20)]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.QUERIES["settings_document_texts"](spark, str(tmp_path)).select("id", "k", "safe", "authoritative", "mode", "release_key").collect()
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(map(tuple, got)) == sorted(c.sql(catalog.ORACLE["settings_document_texts"]).fetchall())
    by = {r.id: r for r in got}
    assert len(by) == len(texts) and all(by[13 + k].release_key == f"text_{k}" for k in range(20))
    assert (by[9].safe, by[9].release_key) == (("ab_" * 100)[:256], "ab_" * 100) and by[10].release_key is None
    spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.read.parquet(f"{tmp_path}/documents.parquet").selectExpr("doc_id", "text", "concat(' ', text) AS source").coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/more/documents.parquet")
    spark.read.parquet(f"{tmp_path}/pages.parquet").coalesce(1).write.parquet(f"{tmp_path}/more/pages.parquet")
    c.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/more/documents.parquet/*.parquet'")
    c.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/more/pages.parquet/*.parquet'")
    every = catalog.QUERIES["settings_texts"](spark, f"{tmp_path}/more").select("id", "k", "safe", "authoritative", "mode", "release_key").collect()
    assert len(every) == 2 * len(texts) + 1 and sorted(map(tuple, every), key=repr) == sorted(c.sql(catalog.ORACLE["settings_texts"]).fetchall(), key=repr)
    assert by[5].mode == "ctf" and by[0].authoritative is None and by[0].safe == "Unknown <7>"

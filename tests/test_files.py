"""Sources and sinks on small hand-made files."""

import pathlib

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from termloom import TermStatistics
from termloom.sinks.text import read_per_document, sort_matrix, write_dictionary, write_matrix, write_rows
from termloom.sources.corpus import corpus_inventory, count_corpus_files, read_corpus
from termloom.sources.dictionary import dense_ids, load_ids, load_stopwords, load_term_dictionary
from termloom.sources.triples import (
    AVERAGES,
    COUNTS,
    TOP_LIST,
    WEIGHTS,
    parse_lenient,
    parse_strict,
    read_averages,
    read_counts,
    read_totals,
    read_weights,
)


def put(root, name, data):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)
    return str(path)


@pytest.fixture
def corpus_dir(tmp_path):
    root = tmp_path / "c"
    put(root, "business/001.txt", b"Don't stop\r\nthe_market! up\r\n\r\nup up\n")
    put(root, "business/002.txt", b"up\tdown\x0bdown\n")
    put(root, "sport/001.txt", "The élan up\n".encode())
    put(root, "sport/002.old.txt", b"down up\rup")
    put(root, "sport/003.txt", b"")
    put(root, "a+b c%/001.txt", b"up")
    put(root, "sport/README.TXT", b"up")
    put(root, "README.TXT", b"up up up")
    return str(root)


@pytest.fixture
def side_files(tmp_path):
    terms = put(tmp_path, "terms.txt", b"up\ndown\nDont\nthemarket\nlan\nThe\ndowndown\nstop\n")
    docs = put(tmp_path, "docs.txt", b"business.001\nbusiness.002\nsport.001\nsport.002\nsport.003\nsport.999\n")
    stops = put(tmp_path, "stop.txt", b"the\nstop\n")
    return terms, docs, stops


def test_corpus_names_and_lines(spark, corpus_dir):
    rows = read_corpus(spark, corpus_dir).collect()
    assert {r["doc_name"] for r in rows} == {
        "business.001",
        "business.002",
        "sport.001",
        "sport.002",
        "a+b c%.001",
        "sport.README",
    }
    assert {r["class"] for r in rows} == {"business", "sport", "a+b c%"}
    lines = sorted(r["text"] for r in rows if r["doc_name"] == "business.001")
    assert lines == ["", "Don't stop", "the_market! up", "up up"]
    assert sorted(r["text"] for r in rows if r["doc_name"] == "sport.002") == ["down up", "up"]


def test_inventory_and_file_count(spark, corpus_dir):
    rows = {tuple(r) for r in corpus_inventory(spark, corpus_dir).collect()}
    assert rows == {
        ("business", "001.txt", "business.001.txt"),
        ("business", "002.txt", "business.002.txt"),
        ("sport", "001.txt", "sport.001.txt"),
        ("sport", "002.old.txt", "sport.002.old.txt"),
        ("a+b c%", "001.txt", "a+b c%.001.txt"),
        ("sport", "003.txt", "sport.003.txt"),  # empty, so no scan shows it
        ("sport", "README.TXT", "sport.README.TXT"),  # only the one beside the class folders is left out
    }
    assert count_corpus_files(spark, corpus_dir).collect()[0]["n_docs"] == 7


def test_file_pipeline(spark, corpus_dir, side_files, out):
    run = TermStatistics.from_files(spark, corpus_dir, *side_files, report_format="%.6f")
    counts = {(r["term_id"], r["doc_id"]): r["freq"] for r in run.counts.collect()}
    assert counts == {
        (1, 1): 3,  # up
        (3, 1): 1,  # Don't
        (4, 1): 1,  # the_market!
        (1, 2): 1,
        (7, 2): 1,  # a vertical tab is deleted, it does not separate
        (1, 3): 1,
        (5, 3): 1,  # élan
        (6, 3): 1,  # The survives a lower-case stop list
        (1, 4): 2,
        (2, 4): 1,
    }
    assert {tuple(r) for r in run.kept.collect()} == {(1, 1, 3), (1, 2, 1), (1, 3, 1), (1, 4, 2)}
    weight = 1.0 + __import__("math").log(8 / 5)
    assert {(r["doc_id"], round(r["tfidf"], 12)) for r in run.tfidf.collect()} == {
        (d, round(weight, 12)) for d in (1, 2, 3, 4)
    }
    # sport has four dictionary documents of which two have no kept term
    averages = {(r["class"], r["term"]): r["avg_tfidf"] for r in run.class_averages.collect()}
    assert averages == pytest.approx({("business", "up"): weight, ("sport", "up"): weight * 2 / 4})

    run.write_all(out, ordered=True)
    assert {tuple(r) for r in read_counts(spark, f"{out}/term_frequency")[0].collect()} == {
        (t, d, n) for (t, d), n in counts.items()
    }
    assert read_counts(spark, f"{out}/low_frequency")[0].count() == 4
    assert [tuple(r) for r in parse_strict(spark.read.text(f"{out}/top_frequency"), TOP_LIST)[0].collect()] == [("up", 7)]
    assert read_weights(spark, f"{out}/tfidf")[0].count() == 4
    report = sorted(r["value"] for r in spark.read.text(f"{out}/top_avg_tfidf").collect())
    assert report == [f"business\tup:{weight:.6f}", f"sport\tup:{weight / 2:.6f}"]


def test_per_document_folders(spark, corpus_dir, side_files, out):
    run = TermStatistics.from_files(spark, corpus_dir, *side_files)
    run.write_per_document(out)
    assert sorted(str(p.relative_to(out)) for p in pathlib.Path(out).glob("class=*/doc_name=*")) == [
        "class=business/doc_name=business.001",
        "class=business/doc_name=business.002",
        "class=sport/doc_name=sport.001",
        "class=sport/doc_name=sport.002",
    ]
    rows = {tuple(r) for r in read_per_document(spark, out).where("doc_name = 'sport.002'").collect()}
    assert rows == {("sport.002", 1, 2), ("sport.002", 2, 1)}


def test_numeric_document_names_stay_text(spark, out):
    rows = spark.sql("SELECT * FROM VALUES (1L, 2L, '1.50'), (1L, 3L, '007') AS t(term_id, freq, doc_name)")
    from termloom.sinks.text import write_per_document

    write_per_document(rows, out)
    assert {tuple(r) for r in read_per_document(spark, out).collect()} == {("1.50", 1, 2), ("007", 1, 3)}


def test_dictionary_keeps_last_line_over_many_splits(spark, tmp_path):
    lines = [f"t{i}" for i in range(150000)] + [f"t{i}" for i in range(50000)]
    path = put(tmp_path, "big.terms", "\n".join(lines).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        ids = load_ids(spark, path, "term", "term_id")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert ids.count() == 150000
    got = dict(ids.where("term in ('t0', 't49999', 't50000', 't149999')").select("term", "term_id").collect())
    assert got == {"t0": 150001, "t49999": 200000, "t50000": 50001, "t149999": 150000}


def test_dictionary_roundtrip_over_part_files(spark, out):
    words = spark.range(1, 20001).select(F.col("id").alias("term_id"), F.concat(F.lit("w"), F.reverse(F.col("id").cast("string"))).alias("term"))
    words = words.groupBy("term").agg(F.max("term_id").alias("term_id"))
    dense = dense_ids(words, "term", "rank").select("rank", "term")
    write_dictionary(dense, "term", "rank", out)
    assert load_ids(spark, out, "term", "rank").exceptAll(dense).count() == 0
    assert load_ids(spark, out, "term", "rank").count() == dense.count()


def test_missing_side_files_fail(spark, tmp_path):
    with pytest.raises(Exception, match="does not exist|Input path"):
        load_term_dictionary(spark, str(tmp_path / "none.terms"))
    with pytest.raises(AnalysisException):
        load_stopwords(spark, str(tmp_path / "none.stop"))


def test_dense_ids_are_ranks_at_any_partitioning(spark):
    keys = spark.range(5000).select((F.xxhash64("id")).alias("k")).distinct()
    want = {k: i for i, k in enumerate(sorted(r["k"] for r in keys.collect()), 1)}
    for partitions in ("1", "7", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            assert dict(dense_ids(keys, "k", "i").select("k", "i").collect()) == want
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")


LINES = ["10\t1\t3", "1\t2\t+4", " 1\t2\t4", "1 2", "1\t2\t4\t9", "1 2 3 ", "1\t2\tx", "", "1\t2\t4.0", "1 2 007\t\t"]


@pytest.fixture
def lines(spark, tmp_path):
    return spark.read.text(put(tmp_path, "m.mtx", "\n".join(LINES).encode()))


def test_strict_triples(lines):
    good, bad = parse_strict(lines, COUNTS)
    assert sorted(tuple(r) for r in good.collect()) == [(1, 2, 3), (1, 2, 4), (1, 2, 7), (10, 1, 3)]
    assert sorted(r["value"] for r in bad.collect()) == sorted([" 1\t2\t4", "1 2", "1\t2\t4\t9", "1\t2\tx", "", "1\t2\t4.0"])


def test_lenient_triples(lines):
    good, bad = parse_lenient(lines, WEIGHTS)
    assert sorted(tuple(r) for r in good.collect()) == [
        (1, 2, 3.0),
        (1, 2, 4.0),
        (1, 2, 4.0),
        (1, 2, 4.0),
        (1, 2, 7.0),
        (10, 1, 3.0),
    ]
    assert sorted(r["value"] for r in bad.collect()) == sorted([" 1\t2\t4", "1 2", "1\t2\tx", ""])


def test_pairs_and_averages(spark, out):
    df = spark.sql("SELECT * FROM VALUES (3L, 10L), (4L, 11L) AS t(term_id, total)")
    write_rows(df, out + "1")
    assert {tuple(r) for r in read_totals(spark, out + "1")[0].collect()} == {(3, 10), (4, 11)}
    avg = spark.sql("SELECT * FROM VALUES ('de', 'den', 1.0E-7D), ('en', 'is', 0.25D) AS t(class, term, avg_tfidf)")
    write_rows(avg, out + "2")
    assert {tuple(r) for r in read_averages(spark, out + "2")[0].collect()} == {("de", "den", 1e-7), ("en", "is", 0.25)}
    assert list(AVERAGES) == avg.columns


def test_doubles_survive_text(spark, out):
    df = spark.range(1, 2001).select(
        F.col("id").alias("term_id"), F.lit(1).cast("bigint").alias("doc_id"), (F.rand(7) / F.col("id") ** 3).alias("tfidf")
    )
    df = spark.createDataFrame(df.collect(), df.schema)
    write_matrix(df, out)
    assert read_weights(spark, out)[0].exceptAll(df).count() == 0


def test_sorted_matrix_orders_ids_as_text(spark):
    df = spark.sql("SELECT * FROM VALUES (2L,1L,1L),(10L,2L,1L),(1L,10L,1L),(1L,9L,1L),(10L,10L,1L) AS t(term_id,doc_id,freq)")
    got = [(r["term_id"], r["doc_id"]) for r in sort_matrix(df).collect()]
    assert got == [(1, 10), (1, 9), (10, 10), (10, 2), (2, 1)]


def test_steps_one_by_one_equal_one_run(spark, corpus_dir, side_files, tmp_path):
    from termloom.__main__ import main

    terms, docs, stops = side_files
    raw = ["--corpus", corpus_dir, "--terms", terms, "--docs", docs, "--stopwords", stops]
    out = {n: str(tmp_path / n) for n in ("p1", "p2", "p3", "p4", "p5", "all", "per")}
    main(["term-frequency", *raw, "--out", out["p1"]])
    main(["low-frequency", "--matrix", out["p1"], "--out", out["p2"]])
    main(["top-frequency", "--matrix", out["p2"], "--terms", terms, "--out", out["p3"]])
    main(["tfidf", "--matrix", out["p2"], "--corpus", corpus_dir, "--out", out["p4"]])
    main(["top-avg-tfidf", "--weights", out["p4"], "--terms", terms, "--docs", docs, "--out", out["p5"]])
    main(["all", *raw, "--out", out["all"]])
    main(["per-document", *raw, "--out", out["per"]])

    def lines(path):
        return sorted(r["value"] for r in spark.read.text(path).collect())

    for step, name in zip(("p1", "p2", "p3", "p4", "p5"), ("term_frequency", "low_frequency", "top_frequency", "tfidf", "top_avg_tfidf")):
        assert lines(out[step]) == lines(f"{out['all']}/{name}"), name
    assert read_per_document(spark, out["per"]).count() == len(lines(out["p1"]))


def test_large_documents_are_several_files(spark, out, monkeypatch):
    from termloom.sinks import text

    monkeypatch.setattr(text, "ROWS_PER_FILE", 100)
    rows = spark.range(1000).select(F.col("id").alias("term_id"), F.lit(2).cast("bigint").alias("freq"), F.lit("a.1").alias("doc_name"))
    text.write_per_document(rows.union(rows.limit(3).withColumn("doc_name", F.lit("b.2"))), out)
    assert len(list(pathlib.Path(out).glob("class=a/doc_name=a.1/part-*"))) > 3
    assert len(list(pathlib.Path(out).glob("class=b/doc_name=b.2/part-*"))) == 1
    assert read_per_document(spark, out).count() == 1003


def test_document_folders_stay_out_of_the_driver(spark, out):
    from termloom.sinks import text

    names = ["a.1", "a.b=c/d:%20 é", "b'[x]^{y}\\", "", "b.#?*\"\t\n", "_c.%41", "ü.1", ".d"]
    rows = spark.createDataFrame([(i, i + 1, n) for i, n in enumerate(names)] + [(9, 1, None)], "term_id long, freq long, doc_name string")
    text.write_per_document(rows, out)
    want = {(n or None, i, i + 1) for i, n in enumerate(names)} | {(None, 9, 1)}
    back = read_per_document(spark, out)
    assert {tuple(r) for r in back.collect()} == want
    assert not back.inputFiles()  # Spark's scan of the folders would hold every file of them in the driver

    # The folders are those of Spark's own writer, and each of the two readers reads both.
    line = F.concat_ws("\t", "term_id", "freq").alias("value")
    spark_out = out + "2"
    rows.select(F.substring_index("doc_name", ".", 1).alias("class"), "doc_name", line).write.partitionBy("class", "doc_name").text(spark_out)
    folders = [sorted(str(p.relative_to(o)) for p in pathlib.Path(o).glob("class=*/doc_name=*")) for o in (out, spark_out)]
    assert folders[0] == folders[1]
    assert {tuple(r) for r in read_per_document(spark, spark_out).collect()} == want
    plain = spark.read.schema("value STRING, class STRING, doc_name STRING").text(out)
    assert {(r["doc_name"], *map(int, r["value"].split("\t"))) for r in plain.collect()} == want
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        text.write_per_document(rows, out)


def test_null_shares_are_written_as_such(spark, out):
    df = spark.sql("SELECT * FROM VALUES (1L, 1L, CAST(NULL AS DOUBLE)), (2L, 1L, 0.5D) AS t(term_id, doc_id, tfidf)")
    write_matrix(df, out)
    assert sorted(r["value"] for r in spark.read.text(out).collect()) == ["1\t1\tNaN", "2\t1\t0.5"]
    with pytest.raises(Exception, match="null in column doc_id"):
        write_matrix(spark.sql("SELECT 1L AS term_id, CAST(NULL AS BIGINT) AS doc_id, 1L AS freq"), out + "2")


def values(spark, path):
    return sorted(r["value"] for r in spark.read.text(path).collect())


def test_rejected_lines_are_kept_and_counted(spark, tmp_path, corpus_dir, capsys):
    from termloom.__main__ import main

    path = put(tmp_path, "m.mtx", b"1\t1\t0\n2\t2\t3\n3\t2\t0\nbad\n1 2\n1\t2\tx\n")
    for command, more in (("tfidf", ["--corpus", corpus_dir]), ("tf", []), ("totals", []), ("low-frequency", [])):
        out = str(tmp_path / command)
        main([command, "--matrix", path, *more, "--out", out])
        assert values(spark, out + ".rejects") == sorted(["bad", "1 2", "1\t2\tx"])
        assert "3 lines rejected" in capsys.readouterr().out
    assert [v.split("\t")[:2] for v in values(spark, str(tmp_path / "tfidf"))] == [["1", "1"], ["2", "2"], ["3", "2"]]
    assert values(spark, str(tmp_path / "tf")) == ["1\t1\tNaN", "2\t2\t1.0", "3\t2\t0.0"]
    assert values(spark, str(tmp_path / "totals")) == ["1\t0", "2\t3", "3\t0"]


def test_flags_reach_their_outputs(spark, corpus_dir, side_files, tmp_path):
    from termloom.__main__ import main

    terms, docs, stops = side_files
    raw = ["--corpus", corpus_dir, "--terms", terms, "--docs", docs, "--stopwords", stops]
    plain, changed = str(tmp_path / "plain"), str(tmp_path / "changed")
    main(["all", *raw, "--min-total", "1", "--out", plain])
    flags = ["--plain-idf", "--top", "1", "--top-per-class", "1", "--min-total", "2", "--report-format", "%.3f"]
    main(["all", *raw, *flags, "--broadcast-limit", "0", "--out", changed])
    for name in ("low_frequency", "top_frequency", "tfidf", "top_avg_tfidf"):
        assert values(spark, f"{plain}/{name}") != values(spark, f"{changed}/{name}"), name
    assert values(spark, f"{plain}/term_frequency") == values(spark, f"{changed}/term_frequency")
    assert len(values(spark, f"{changed}/top_frequency")) == 1
    for refused in (["tfidf", "--matrix", "x", "--corpus", "y", "--out", "z", "--min-total", "3"], ["totals", "--matrix", "x", "--out", "y", "--top", "1"]):
        with pytest.raises(SystemExit):
            main(refused)

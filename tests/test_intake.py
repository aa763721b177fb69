"""File triage on bytes, names and page tables."""

from pyspark.sql import functions as F

from tallywright.operators import intake
from tallywright.sources.documents import list_documents, triage_folder, triage_manifest

PAGES = "source_file string, page_no int, text string, is_encrypted boolean"


def write(folder, **files):
    for name, content in files.items():
        (folder / name.replace("__", ".")).write_bytes(content)


def test_folder_triage(spark, tmp_path):
    write(
        tmp_path,
        good__pdf=b"%PDF-1.7 body",
        late__pdf=b" " * 1000 + b"%PDF-1.4",
        too_late__pdf=b" " * 1030 + b"%PDF-1.4",
        empty__pdf=b"",
        locked__pdf=b"%PDF-1.7 \xff\xfe trailer << /Encrypt 5 0 R >> startxref 0 %%EOF",
        nopages__pdf=b"%PDF-1.7",
        scan__pdf=b"%PDF-1.7",
        UPPER__PDF=b"%PDF-1.7",
        notes__txt=b"%PDF-1.7",
    )
    (tmp_path / "deeper").mkdir()
    write(tmp_path / "deeper", inner__pdf=b"%PDF-1.7")
    names = [n for n in ("good", "late", "too_late", "empty", "locked", "scan")]
    rows = [(f"{n}.pdf", i, " \n" if n == "scan" else f"{n}{i}", False) for n in names for i in (1, 2)]
    pages = spark.createDataFrame(rows, PAGES)
    result = {r.source_file: r for r in triage_folder(spark, str(tmp_path), pages).collect()}
    reasons = {name: row.reason for name, row in result.items()}
    corrupt = "Could not open file - it may be corrupted: "
    assert reasons == {
        "good.pdf": "OK",
        "late.pdf": "OK",
        "scan.pdf": "OK",
        "too_late.pdf": corrupt + "no %PDF- signature",
        "locked.pdf": "PDF is password protected",
        "nopages.pdf": "PDF has no pages",
    }
    assert (result["locked.pdf"].page_count, result["too_late.pdf"].page_count) == (2, 0)
    assert result["good.pdf"].has_text_layer and not result["scan.pdf"].has_text_layer
    counts = intake.triage_counts(triage_folder(spark, str(tmp_path), pages)).first()
    assert tuple(counts) == (6, 3, 3)

    # Spark lists no empty files; the manifest names them.
    named = [("good.pdf", 13), ("empty.pdf", 0), ("gone.pdf", 9)]
    manifest = spark.createDataFrame(named, "source_file string, length bigint")
    result = triage_folder(spark, str(tmp_path), pages, manifest).collect()
    assert {row.source_file: (row.reason, row.page_count) for row in result} == {
        "good.pdf": ("OK", 2),
        "empty.pdf": (corrupt + "empty file", 0),
        "gone.pdf": ("File does not exist on disk", 0),
    }


def test_listing_does_not_read_content_unless_asked(spark, tmp_path):
    write(tmp_path, a__pdf=b"%PDF-1.7")
    plan = list_documents(spark, str(tmp_path)).select("path", "length")
    assert "content" not in plan._jdf.queryExecution().executedPlan().toString()


def test_empty_folder(spark, tmp_path):
    pages = spark.createDataFrame([], PAGES)
    triaged = triage_folder(spark, str(tmp_path), pages)
    assert tuple(intake.triage_counts(triaged).first()) == (0, 0, 0)


def test_manifest_names_missing_files_and_suffixes(spark):
    names = ["gone.pdf", "a.PDF", "b.txt", "c", ".pdf", "d.tar.gz"]
    manifest = spark.createDataFrame([(n,) for n in names], "source_file string")
    files = manifest.filter("source_file <> 'gone.pdf'").select(
        "source_file", F.lit(None).cast("string").alias("open_error"), F.lit(False).alias("is_encrypted")
    )
    pages = spark.createDataFrame([("a.PDF", 1, "x", False)], PAGES)
    rows = {r.source_file: r.reason for r in triage_manifest(manifest, files, pages).collect()}
    assert rows == {
        "gone.pdf": "File does not exist on disk",
        "a.PDF": "OK",
        "b.txt": "Expected a .pdf file, got '.txt'",
        "c": "Expected a .pdf file, got ''",
        ".pdf": "Expected a .pdf file, got ''",
        "d.tar.gz": "Expected a .pdf file, got '.gz'",
    }


def test_text_layer_is_whole_and_in_page_order(spark):
    rows = [("a", n, f"<{n}>", False) for n in (3, 1, 2, 12, 0, 11)] + [("b", 0, None, False)]
    pages = spark.createDataFrame(rows, PAGES)
    one = {r.source_file: r for r in intake.text_layer(pages).collect()}
    assert one["a"].text == "<0><1><2><3><11><12>" and (one["a"].segment, one["a"].start) == (0, 0)
    assert one["b"].text == "" and not one["b"].segment_has_text
    long = pages.filter("source_file = 'a'")
    for rows_in_slice in (1 << 20, 3, 1):
        found = intake.text_layer(long, segment_chars=7, slice_rows=rows_in_slice).orderBy("segment").collect()
        assert [(r.segment, r.start, r.n_pages, r.text) for r in found] == [
            (0, 0, 3, "<0><1><2>"),
            (1, 9, 2, "<3><11>"),
            (2, 16, 1, "<12>"),
        ]


def test_a_file_of_5000_pages_spreads_over_tasks(spark):
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    page = F.concat(F.lit("page "), F.col("id"), F.lit(" "), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")))
    pages = spark.range(5000).select(
        F.lit("long.pdf").alias("source_file"), (F.col("id") * 7 % 5000).cast("int").alias("page_no"), page.alias("text")
    )
    spark.conf.set(setting, "false")  # the table is tiny; keep its partitions apart
    try:
        found = intake.text_layer(pages, segment_chars=4096, slice_rows=100).withColumn("task", F.spark_partition_id())
        rows = sorted(found.collect(), key=lambda r: r.segment)
    finally:
        spark.conf.unset(setting)
    whole = "".join(r.text for r in sorted(pages.collect(), key=lambda r: r.page_no))
    assert "".join(r.text for r in rows) == whole
    assert [r.start for r in rows] == [sum(len(x.text) for x in rows[:n]) for n in range(len(rows))]
    assert max(len(r.text) for r in rows) < 4096 + 70 and len({r.task for r in rows}) > 4
    assert sum(r.n_pages for r in rows) == 5000


def pdf(body=b"", entries=b"/Size 3", table=b"0000000000 65535 f \n", tail=b""):
    """A file with a cross-reference table and its trailer."""
    start = b"%PDF-1.7\n" + body
    table = b"xref\n0 1\n" + table + b"trailer\n<< " + entries + b" >>\n"
    return start + table + b"startxref\n" + str(len(start)).encode() + b"\n%%EOF\n" + tail


def test_encryption_is_an_entry_of_the_trailer(spark, tmp_path):
    page = b"4 0 obj << /Length 40 >> stream\n/Encrypt 5 0 R trailer << /Encrypt 5 0 R >>\nendstream endobj\n"
    locked = b"/Size 3 /Encrypt 5 0 R"
    stream = b"%PDF-1.7\n" + page + b"9 0 obj\n<< /Type /XRef /Encrypt 5 0 R /W [1 2 1] >>\nstream\n\x00\x01\nendstream\nendobj\n"
    plain_stream = stream.replace(b"/Type /XRef /Encrypt 5 0 R", b"/Type /XRef")
    at = b"startxref\n%d\n%%%%EOF" % stream.index(b"9 0 obj")
    # The first part of a linearised file, with its own table, is what the end refers to.
    head = b"%PDF-1.7\nxref\n0 1\n0000000000 65535 f \ntrailer\n<< " + locked + b" >>\nstartxref\n0\n%%EOF\n"
    linear = head + b"x" * 90_000 + b"xref\n0 1\ntrailer\n<< /Size 1 >>\nstartxref\n9\n%%EOF\n"
    write(
        tmp_path,
        word__pdf=pdf(page),
        real__pdf=pdf(page, locked),
        inline__pdf=pdf(page, b"/Encrypt<< /V 4 /Filter /Standard >>"),
        string__pdf=pdf(page, b"/Info (see /Encrypt 5 0 R \\) or so) /Size 3"),
        long_table__pdf=pdf(page, locked, b"0000000000 65535 f \n" * 9000),
        long_plain__pdf=pdf(page, b"/Size 3", b"0000000000 65535 f \n" * 9000),
        stream__pdf=stream + at,
        plain_stream__pdf=plain_stream + at,
        linear__pdf=linear,
        updated__pdf=pdf(page, locked) + pdf(page, locked).replace(b"%PDF", b"%pdf"),
        broken__pdf=b"%PDF-1.7 " + page + b"trailer << /Encrypt 5 0 R >>",
        no_place__pdf=pdf(page).replace(b"startxref\n", b"startxref\n99999999999"),
        none__pdf=b"%PDF-1.7 " + page.replace(b"trailer", b"") + b"startxref",
        deep__pdf=b"%PDF-1.7 trailer << /A (" + b"\\(" * 4000 + b") >> startxref 0",
    )
    facts = {r.path.rsplit("/", 1)[-1][:-4]: r.is_encrypted for r in intake.byte_facts(list_documents(spark, str(tmp_path))).collect()}
    yes = {"real", "inline", "long_table", "stream", "linear", "updated", "broken"}
    assert {name for name, found in facts.items() if found} == yes
    assert len(facts) == 14


def test_one_file_does_not_end_the_run(spark, tmp_path):
    write(
        tmp_path,
        long__pdf=b"%PDF-1.7" + b" " * 500,
        word__pdf=b"%PDF-1.7 how to use /Encrypt in a file",
        inline__pdf=b"%PDF-1.7 trailer << /Encrypt<< /V 4 >> >>",
    )
    pages = spark.createDataFrame([(f"{n}.pdf", 1, n, False) for n in ("long", "word", "inline")], PAGES)
    setting = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(setting, "400")
    try:
        reasons = {r.source_file: r.reason for r in triage_folder(spark, str(tmp_path), pages).collect()}
    finally:
        spark.conf.unset(setting)
    assert reasons == {
        "long.pdf": "Could not open file - it may be corrupted: longer than 400 bytes",
        "word.pdf": "OK",
        "inline.pdf": "PDF is password protected",
    }

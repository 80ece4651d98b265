import glob
import os

import pytest
from pyspark.sql import functions as F

from citeweave.operators import records as R
from citeweave.operators.lines import section
from citeweave.plans import queries as PQ
from citeweave.plans.references import ParseOptions, bare_year_references, references, section_lines
from citeweave.sources import readers, writers

APA = """Some intro text
References
Smith, A. B., Jones, C. &
Doe, J. (2001). A title of some
length. Journal of Things, 1, 2-3. doi: 10.1234/abcd.
5678
(cid:12)
123
Brown, D. (2010). Another ti-
tle. https://doi.org/10.5555/xyz
Appendix
Not, A. (2000). reference
"""
BARE = "Bibliography\nSmith, A. B.\nTitle of the work, Press,\nTown, 1999.\nJones, C., Other work with many words, City, 2005.\n"


def test_reference_lists(spark):
    numbered = "References\n" + "\n".join(f"[{i}] Author {i}, Title.\ncontinued {i}" for i in range(1, 18))
    docs = spark.createDataFrame([("apa", APA), ("num", numbered), ("none", None), ("empty", "")], "doc_id string, full_text string")
    found = {}
    for r in references(docs).orderBy("doc_id", "line_no").collect():
        found.setdefault(r["doc_id"], []).append((r["text"], r["doi_ids"]))
    assert [x[1] for x in found["apa"]] == [["10.1234/abcd.5678"], ["10.5555/xyz"]]
    assert found["apa"][0][0].startswith("Smith, A. B., Jones, C. & Doe, J. (2001). A title of some length.")
    assert len(found["num"]) == 17 and found["num"][0][0] == "[1] Author 1, Title. continued 1"
    assert set(found) == {"apa", "num"}


def test_bare_years(spark):
    docs = spark.createDataFrame([(1, BARE)], "doc_id int, full_text string")
    rows = bare_year_references(section_lines(docs, ParseOptions()), ParseOptions(layout="A")).orderBy("line_no").collect()
    assert [r["text"] for r in rows] == ["Smith, A. B. Title of the work, Press, Town, 1999.", "Jones, C., Other work with many words, City, 2005."]


def test_sources(spark, tmp_path):
    (tmp_path / "a.txt").write_text(APA)
    docs = readers.read_texts(spark, str(tmp_path / "a.txt"))
    assert docs.first()["full_text"] == APA
    (tmp_path / "j.csv").write_text('"JOURNAL";"YEAR";"ISSUE";"ISSN";"DOI";"TITLE";"PUBLICATION DATE";"LINK TO ARTICLE";"AU1 FIRST NAME";"AU1 LAST NAME"\n"J";"2001.0";"1";"1234-567x";"10.1/a";"T & U";"2001-02-03";"http://x";"Ann";"Lee"\n"J";"2001.0";"1";"";"nan";"";"";"";"";""\n')
    records = R.journal_records(readers.read_journal_csv(spark, str(tmp_path / "j.csv")))
    row = R.journal_xml(records).first()
    assert row["n_articles"] == 1 and row["issn"] == "1234-567X" and row["issue_date"] == "2001-02-03"
    assert "<title>T &amp; U</title>" in row["xml"] and '<person_name sequence="first" contributor_role="author">' in row["xml"]
    batch = R.batch_xml(R.journal_xml(records), R.DepositOptions(depositor="D")).first()["xml"]
    assert batch.startswith("<?xml") and "<depositor_name>D</depositor_name>" in batch and batch.endswith("</doi_batch>")
    assert parsed(batch).get("version") == "5.4.0" and len(parsed(batch)) == 2
    (tmp_path / "m.xml").write_text('<mods:modsCollection xmlns:mods="http://www.loc.gov/mods/v3"><mods:mods><mods:genre authority="kev">book</mods:genre><mods:titleInfo lang="eng"><mods:title>Big &lt;i&gt;book&lt;/i&gt;</mods:title></mods:titleInfo><mods:name><mods:namePart type="family">Lee</mods:namePart><mods:namePart type="given">Ann</mods:namePart><mods:role><mods:roleTerm>aut</mods:roleTerm></mods:role></mods:name><mods:identifier type="doi">10.1/b</mods:identifier><mods:originInfo><mods:dateIssued>2001</mods:dateIssued></mods:originInfo></mods:mods></mods:modsCollection>')
    mods = R.record_xml(R.mods_records(readers.read_mods(spark, str(tmp_path / "m.xml")))).first()
    assert mods["record_type"] == "book" and mods["titles"][0]["title"] == "Big book" and mods["contributors"][0]["surname"] == "Lee" and mods["book_type"] == "monograph"
    assert "<doi>10.1/b</doi>" in mods["xml"]
    lines = spark.createDataFrame([(1, 2, "b", "10.1/x/y"), (1, 1, "a", "10.1/x/y")], "doc_id int, line_no int, text string, doi string")
    writers.write_sections(docs.select("doc_id", section(F.col("full_text")).alias("text")), str(tmp_path / "sections"))
    assert spark.read.parquet(str(tmp_path / "sections")).first()["text"].lstrip().startswith("Smith, A. B.")
    writers.write_references(lines, str(tmp_path / "all"))
    assert [r["text"] for r in spark.read.parquet(str(tmp_path / "all")).orderBy("line_no").collect()] == ["a", "b"]
    writers.write_references(lines, str(tmp_path / "out"), per_document=True)
    text = "".join(open(f).read() for f in glob.glob(str(tmp_path / "out/*/*.txt")))
    assert text == "a\nb\n"
    writers.write_by_doi(lines, str(tmp_path / "doi"))
    assert "".join(open(f).read() for f in glob.glob(str(tmp_path / "doi/name=x_y/*.txt"))) == "10.1/x/y\na\nb\n"


def test_a_deposit_is_copied_once(spark):
    rows = spark.createDataFrame([("<b/>",), ("<a/>",), (None,), ("<b/>",)], "xml string")
    for records, body in ((rows, "<a/><b/><b/>"), (rows.where("false"), ""), (rows.where("xml is null"), "")):
        out = R.batch_xml(records, R.DepositOptions(depositor="D & Co"))
        (row,) = out.collect()
        assert row["batch"] == 0 and row["xml"].endswith(f"<registrant></registrant></head><body>{body}</body></doi_batch>")
        assert row["xml"].startswith('<?xml version="1.0" encoding="UTF-8"?><doi_batch xmlns="http://www.crossref.org/schema/5.4.0" xmlns:xsi=') and ' version="5.4.0"><head><doi_batch_id>batch</doi_batch_id>' in row["xml"]
    plan = R.batch_xml(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_join" not in plan and plan.count("concat_ws(") == 1  # no other text holds the whole deposit


def parsed(xml):
    from xml.etree import ElementTree

    return ElementTree.fromstring(xml.encode())


def plain(xml):
    """An XML text as nested (name, attributes, text, children), namespaces aside."""

    def one(e):
        return e.tag.rpartition("}")[2], dict(e.attrib), (e.text or "").strip(), [one(x) for x in e]

    return one(parsed(xml.replace("jats:", "").replace("xml:lang", "lang")))


MODS = """<mods:modsCollection xmlns:mods="http://www.loc.gov/mods/v3">
<mods:mods><mods:genre authority="kev">dissertation</mods:genre><mods:genre type="publicationTypeCode">monographLicentiateThesis</mods:genre><mods:titleInfo lang="deu"><mods:title>T &lt;i&gt;x&lt;/i&gt;</mods:title><mods:subTitle>S</mods:subTitle></mods:titleInfo>
<mods:name><mods:namePart type="family">Lee</mods:namePart><mods:namePart type="given">Ann</mods:namePart><mods:role><mods:roleTerm>aut</mods:roleTerm></mods:role><mods:affiliation>Some Place</mods:affiliation><mods:affiliation>Home University, Dept</mods:affiliation><mods:description>orcid.org=0000-1</mods:description></mods:name>
<mods:name><mods:namePart type="family">Ek</mods:namePart><mods:role><mods:roleTerm>edt</mods:roleTerm></mods:role></mods:name>
<mods:originInfo><mods:dateIssued>2001</mods:dateIssued><mods:dateOther type="defence">2002-03-04T10:00</mods:dateOther></mods:originInfo><mods:identifier type="doi">10.1/a</mods:identifier><mods:identifier type="uri">http://u/a</mods:identifier><mods:identifier type="isbn" displayLabel="electronic">978-1</mods:identifier>
<mods:location><mods:url displayLabel="fulltext">http://f/a</mods:url></mods:location><mods:abstract lang="eng">&lt;p&gt;One  two&lt;/p&gt;&lt;p&gt; &lt;/p&gt;&lt;p&gt;3&lt;/p&gt;</mods:abstract><mods:abstract lang="xxx"> plain
text </mods:abstract></mods:mods>
<mods:mods><mods:genre type="publicationTypeCode">report</mods:genre><mods:titleInfo lang="eng"><mods:title>R</mods:title></mods:titleInfo><mods:originInfo><mods:dateIssued>2003</mods:dateIssued><mods:publisher>Press</mods:publisher></mods:originInfo><mods:identifier type="doi">10.1/b</mods:identifier><mods:relatedItem><mods:titleInfo><mods:title>Series</mods:title></mods:titleInfo><mods:identifier type="issn">1234-5678</mods:identifier></mods:relatedItem></mods:mods>
<mods:mods><mods:genre authority="kev">book</mods:genre><mods:genre authority="svep">sam</mods:genre><mods:titleInfo lang="swe"><mods:title>B</mods:title></mods:titleInfo><mods:originInfo><mods:dateIssued>2004</mods:dateIssued></mods:originInfo><mods:identifier type="doi">10.1/c</mods:identifier><mods:relatedItem><mods:titleInfo><mods:title>Series</mods:title></mods:titleInfo><mods:identifier type="issn">1234-5678</mods:identifier></mods:relatedItem></mods:mods>
<mods:mods><mods:genre authority="kev">article</mods:genre><mods:identifier type="doi">10.1/d</mods:identifier></mods:mods>
</mods:modsCollection>"""


def test_record_xml(spark, tmp_path):
    """Elements of all three kinds of records, in the order of the schema."""
    (tmp_path / "m.xml").write_text(MODS)
    options = R.DepositOptions(institutions=("Home University", "Hemma"), institution_ids=(("ror", "https://r/1"), ("isni", "2")))
    mods = readers.read_mods(spark, str(tmp_path / "m.xml"))
    xml = {r["doi"]: plain(r["xml"]) for r in R.record_xml(R.mods_records(mods, options)).collect()}
    ids = [("institution_id", {"type": "ror"}, "https://r/1", []), ("institution_id", {"type": "isni"}, "2", [])]
    leaf = lambda n, t: (n, {}, t, [])
    home = lambda name, *more: ("institution", {}, "", [leaf("institution_name", name), *more])
    who = [
        ("person_name", {"contributor_role": "author", "sequence": "first"}, "", [leaf("given_name", "Ann"), leaf("surname", "Lee"), ("affiliations", {}, "", [home("Some Place"), home("Home University, Dept", *ids)]), leaf("ORCID", "https://orcid.org/0000-1")]),
        ("person_name", {"contributor_role": "editor", "sequence": "first"}, "", [leaf("surname", "Ek"), ("affiliations", {}, "", [])]),
    ]
    similar = ("collection", {"property": "crawler-based"}, "", [("item", {"crawler": "similarity-check"}, "", [leaf("resource", "http://f/a")])])
    assert xml["10.1/a"] == ("dissertation", {"publication_type": "full_text", "language": "de"}, "", [
        ("contributors", {}, "", who), ("titles", {}, "", [leaf("title", "T x"), leaf("subtitle", "S")]), ("abstract", {"lang": "en"}, "", [leaf("p", "One two"), leaf("p", "3")]), ("abstract", {}, "", [leaf("p", "plain text")]),
        ("approval_date", {}, "", [leaf("month", "03"), leaf("day", "04"), leaf("year", "2002")]), home("Some Place", *ids), leaf("degree", "Licentiate thesis"), leaf("isbn", "9781"), ("doi_data", {}, "", [leaf("doi", "10.1/a"), leaf("resource", "http://u/a"), similar]),
    ])
    series = ("series_metadata", {}, "", [("titles", {}, "", [leaf("title", "Series")]), leaf("issn", "1234-5678")])
    rest = lambda t, y, d, *p: [series, ("contributors", {}, "", []), ("titles", {}, "", [leaf("title", t)]), ("publication_date", {}, "", [leaf("year", y)]), *p, ("doi_data", {}, "", [leaf("doi", d)])]
    assert xml["10.1/b"] == ("report-paper", {}, "", [("report-paper_series_metadata", {"language": "en"}, "", rest("R", "2003", "10.1/b", ("publisher", {}, "", [leaf("publisher_name", "Press")])))])
    assert xml["10.1/c"] == ("book", {"book_type": "edited_book"}, "", [("book_series_metadata", {}, "", rest("B", "2004", "10.1/c"))])
    assert set(xml) == {"10.1/a", "10.1/b", "10.1/c"}
    kinds = {g: [tuple(r) for r in R.mods_records(mods, R.DepositOptions(genre=g)).select("record_type", "book_type").distinct().collect()] for g in ("coll", "book", "report")}
    assert kinds == {"coll": [("book", "edited_book")], "book": [("book", "monograph")], "report": [("report", None)]}
    many = spark.range(40).selectExpr("concat('<x>', id, '</x>') as xml")
    batches = R.batch_xml(many, options, per_batch=10).collect()
    assert sorted(int(x.text) for r in batches for x in parsed(r["xml"])[1]) == list(range(40)) and len({r["batch"] for r in batches}) == len(batches) > 1
    assert R.batch_xml(R.record_xml(R.mods_records(mods.where("false"))), options).count() == 1


def test_fetch(spark):
    """Pages and PDF files by HTTP; wrong kinds, refusals and odd addresses are errors in their rows."""
    import http.server
    import threading

    class Server(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            self.send_response(404 if "no" in self.path else 200)
            self.send_header("Content-Type", "application/pdf" if self.path.endswith(".pdf") else "text/html; charset=utf-8")
            self.end_headers()
            self.wfile.write(b"<p>h\xc3\xa9 \xff</p>")

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    at = f"http://127.0.0.1:{server.server_port}"
    urls = spark.createDataFrame([(f"{at}/a.pdf",), (f"{at}/b",), (f"{at}/no",), ("file:///etc/hosts",), (None,)], "url string")
    pages = {r["url"]: r for r in readers.fetch_pages(urls).collect()}
    assert pages[f"{at}/b"]["html"] == "<p>h\u00e9 \ufffd</p>" and "404" in pages[f"{at}/no"]["error"] and pages["file:///etc/hosts"]["error"] == pages[None]["error"] == "no http address"
    files = {r["url"]: r for r in readers.fetch(urls, kind="application/pdf").collect()}
    assert files[f"{at}/a.pdf"]["content"] and files[f"{at}/b"]["error"] == "content is text/html" and files[f"{at}/b"]["content"] is None
    assert readers.fetch(urls, most_bytes=3).where("error = 'content is too long'").count() == 2
    server.shutdown()


def test_audit(spark):
    from citeweave.operators import lines as L

    docs = spark.createDataFrame([(1, "a\n\n- -\n(cid:3)\n123\n2003/04/05 12:30 Page 3 #4\nAppendix\nb")], "doc_id int, full_text string")
    rows = L.physical_lines(docs)
    got = {(r["line_no"], r["reason"]) for r in L.line_audit(rows).collect()}
    assert got == {(2, "blank"), (3, "hyphens only"), (4, "character id"), (5, "page number"), (6, "time stamp"), (7, "stop token"), (8, "after a stop token")}
    assert {(r["line_no"]) for r in L.line_audit(rows, until_eof=True).collect()} == {2, 3, 4, 5, 6}
    assert [tuple(r) for r in writers.audit(rows, L.clean_lines(rows), "clean").collect()] == [(1, "clean", 8, 1)]


def test_pdf_cascade(spark, tmp_path, monkeypatch):
    (tmp_path / "x.pdf").write_bytes(b"hello")
    assert readers.read_pdfs(spark, str(tmp_path / "x.pdf")).first()["full_text"] is None  # no backend is installed
    monkeypatch.setitem(readers.PDF_BACKENDS, "blank", lambda b: " ")
    monkeypatch.setitem(readers.PDF_BACKENDS, "plain", lambda b: b.decode())
    assert readers.read_pdfs(spark, str(tmp_path / "x.pdf"), ["blank", "plain"]).first()["full_text"] == "hello"


def test_html():
    assert readers.html_references('<div class="x references"><p>A <b>b</b><div><h6>C</h6></div></div><p>no</p>') == ["A b", "C"]
    assert readers.html_references("<h2>References</h2><p>A<p>B</p><h4>Next</h4><p>C</p>") == ["A", "B"]
    assert readers.html_references(None) == [] and readers.html_references("<p>x") == []


def test_stream(spark, tmp_path):
    from citeweave.streaming import line_stream, read_text_stream, reference_stream

    os.makedirs(tmp_path / "in")
    (tmp_path / "in/a.txt").write_text(APA)
    q = reference_stream(read_text_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check"))
    assert q.awaitTermination(240) and spark.read.parquet(str(tmp_path / "out")).count() == 2
    q = line_stream(read_text_stream(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("lines_out").outputMode("append").trigger(availableNow=True).start()
    assert q.awaitTermination(120) and spark.table("lines_out").where("size(doi_ids) > 0").count() >= 1


@pytest.mark.parametrize("name", sorted(PQ.oracle_sql()))
def test_oracle(spark, sf, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    spark_rows = PQ.queries()[name](spark, sf)
    other = con.sql(PQ.oracle_sql()[name])
    assert sorted(spark_rows.columns) == sorted(other.columns)
    columns = sorted(other.columns)
    text = lambda r: str(tuple(round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in r))
    want = sorted(text(r) for r in con.sql(f"select {', '.join(chr(34) + c + chr(34) for c in columns)} from ({PQ.oracle_sql()[name]})").fetchall())
    assert sorted(text(r) for r in spark_rows.select(*columns).collect()) == want


def test_queries_without_oracle(spark, sf):
    """Few, and those that only a sequential program expresses; test_lists.py holds them against chains over rows."""
    without = set(PQ.queries()) - set(PQ.oracle_sql())
    assert len(without) <= 10
    for name in without:
        assert PQ.queries()[name](spark, sf).where("text <> ''").count() > 0, name


def test_oracles_tell_apart(spark, sf):
    """The data reach both sides of every predicate, every style of list and reason, and what splits."""
    queries = PQ.queries()
    for name in queries:
        if name.startswith("pred_"):
            flags = queries[name](spark, sf.replace("0.001", "0.01")).groupBy("flag").count().collect()
            assert {r["flag"] for r in flags} == {True, False}, name
    big = sf.replace("0.001", "0.01")
    assert {r[0] for r in queries["numbered_style"](spark, big).select("style").distinct().collect()} == {"bracket", "paren", "bare", None}
    assert len({r[0] for r in queries["line_audit"](spark, big).select("reason").distinct().collect()}) == 7
    assert queries["split_trailers"](spark, big).count() > queries["strip_number"](spark, big).count()

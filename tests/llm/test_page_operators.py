"""Operators on pages, and the mix and the pipeline, against brute force and round trips."""

import hashlib
import html as html_lib
import re
from collections import Counter, defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import extract, mixing, queries, url_filters, warc
from tools.compare import compare, duck

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


# --- extraction -----------------------------------------------------------------------------

def article_by_hand(page):
    """Blocks of the article of the synthetic pages, which close every article."""
    found = re.search(r"<article>(.*?)</article>", page or "", re.S)
    blocks = re.split(r"</?(?:p|h\d)>", re.sub(r"</?[bi]>", "", found[1].replace("<br>", " "))) if found else []
    texts = [re.sub(r"\s+", " ", html_lib.unescape(b)).strip() for b in blocks]
    return "\n".join(t for t in texts if t)


def test_extraction_of_all_pages(spark):
    rows = {r.page_id: r for r in pages(spark).collect()}
    got = {r.page_id: r for r in extract.extracted(pages(spark).withColumn("low", F.lit(1)).repartition(3)).collect()}
    assert got.keys() == rows.keys()
    for k, r in got.items():
        assert (r.text, r.n_chars, r.url) == (article_by_hand(rows[k].html), len(r.text), rows[k].url)


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain &lt;b&gt; text", "plain <b> text"), ("<p>one<p>two <b>bold", "one\ntwo bold"),
    ("<article><p>a\n\n b\t c</p></article", "a b c"), ("<p>x</p><!-- <p>no</p> --><script>var a='<p>';</script><style>p{}</style><p>y", "x\ny"),
    ("<body><header>h</header><nav><a>m</a></nav><aside>s</aside><main><h1>T</h1><p>body</p><form>f</form><div class='comments'>"
     "<p>c</p></div><section id='related-posts'>r</section></main><footer>f</footer>", "T\nbody"),
    ("<div class='cookie-notice'>c</div><div id=sidebar>s</div><div role=banner>b</div><div class=post>kept<br>line</div>", "kept line"),
    ("<ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table>", "one\ntwo\na\nb\nc"),
    ("<article>" + "<div>" * 300 + "deep" + "</div>" * 300 + "</article>", "deep"), ("<p>a<span hidden>h</span>b</p>", "a\nb"),
    ("&#x41;&#66;&eacute;&nbsp;&unknown; &am", "ABé &unknown; &am"),
])
def test_main_text(page, text):
    assert extract.main_text(page)[0] == text


def test_style_tree_removes_what_a_site_repeats(spark):
    """Branches without a telling name: the same promotion on every page goes, the varying story stays."""
    rows = [(k, f"http://site.example/{k}", f"<body><div class='box'><p>Buy our things now</p></div><div class='story'><h2>Title {k}</h2>"
             + "".join(f"<p>Story {k} part {j}</p>" for j in range(k % 4 + 1)) + "</div></body>") for k in range(30)]
    few = [(100 + k, "http://small.example/", "<body><div class='box'><p>Buy our things now</p></div></body>") for k in range(3)]
    got = {r.page_id: r.text for r in extract.extracted(spark.createDataFrame(rows + few, PAGES)).collect()}
    for k in range(30):
        assert got[k] == "\n".join([f"Title {k}", *(f"Story {k} part {j}" for j in range(k % 4 + 1))])
    assert got[100] == "Buy our things now"  # three pages say nothing about a site


@pytest.mark.parametrize("named, texts", [(0.15, {"Story"}), (0.6, {"Story\nCookies {k}"}), (1.0, {"Story\nCookies {k}"})])
def test_names_only_weigh_what_the_tree_finds(spark, named, texts):
    """A menu that is the same on every page goes whatever its name weighs; a notice that varies goes by its weight only."""
    rows = [(k, f"http://site.example/{k}", f"<body><nav>Home News</nav><section><h2>Story {k}</h2></section>"
             f"<div class=cookies>Cookies {k}</div></body>") for k in range(30)]
    got = extract.extracted(spark.createDataFrame(rows, PAGES), options=extract.Options(named=named)).collect()
    for r in got:
        assert {r.text} == {t.format(k=r.page_id).replace("Story", f"Story {r.page_id}") for t in texts}
        assert (r.removed_as_repeated, r.removed_as_named) == (1, int(named < 0.2))


def test_copies_of_an_article_keep_their_text(spark):
    page = "<nav><a>m</a></nav><article><h1>T</h1><p>same on every page</p></article>"
    got = extract.extracted(spark.createDataFrame([(k, "http://a.example/x", page) for k in range(40)] + [(99, None, page)], PAGES))
    assert {r.text for r in got.collect()} == {"T\nsame on every page"}
    assert extract.extracted(pages(spark).limit(0)).count() == 0


# --- archives -------------------------------------------------------------------------------

def test_archives_round_trip(spark, tmp_path):
    big = "<p>" + "é" * 400_000
    extra = [(9001, "http://a/1", big), (9000, "http://a/2", big), (9002, None, "short"), (9003, "http://a/\r\nX: y", "short"),
             (9004, "http://b", None), (9005, "http://b", ""), (9006, "u", "WARC/1.1\r\n\r\n" * 20), (9007, "u", "x" * 99), (9008, "u", "x" * 99),
             (9009, "u", "x" * 100), (9010, "u", "x" * 100)]
    source = pages(spark).unionByName(spark.createDataFrame(extra, PAGES)).repartition(3)
    rows = {r.page_id: (r.html or "").encode() for r in source.collect()}
    folder = str(tmp_path / "archives")
    index = warc.write_bundles(source.withColumn("digest", F.lit("x")), folder, frame_bytes=20_000, bundle_bytes=60_000)
    stray = tmp_path / "archives" / "bundle-of-a-failed-attempt.warc.zst"
    stray.write_bytes(b"half a bundle")
    firsts = {}
    for page_id in sorted(rows):
        if len(rows[page_id]) >= 100:
            firsts.setdefault(rows[page_id], page_id)
    got = {r.page_id: r for r in warc.read_bundles(spark, folder, index).collect()}
    assert got.keys() == rows.keys()
    for k, payload in rows.items():
        first = firsts.get(payload, k)
        want = ("response", None, payload) if first == k else ("revisit", first, b"")
        assert (got[k].record_type, got[k].refers_to, bytes(got[k].payload)) == want
        assert (got[k].payload_bytes, got[k].payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
    places = index.collect()
    assert len({p.bundle for p in places}) > 1 and max(p.frame for p in places) > 0
    for p in places:  # one record by its index entry; the place is where the reader found it
        headers, payload = warc.lookup(folder, p.bundle, p.frame, p.offset)
        assert headers["X-Page-ID"] == str(p.page_id) and payload == bytes(got[p.page_id].payload)
        assert (p.bundle, p.frame, p.offset) == (got[p.page_id].bundle, got[p.page_id].frame, got[p.page_id].offset)
    bundle = (tmp_path / "archives" / places[0].bundle).read_bytes()
    whole = zstandard.ZstdDecompressor().stream_reader(bundle, read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\nWARC-Type") == sum(p.bundle == places[0].bundle for p in places)


def test_archives_of_nothing(spark):
    assert warc.archived(pages(spark).limit(0)).count() == 0
    again = spark.createDataFrame([(1, "u", "y" * 200), (1, "u", "y" * 200), (None, None, "y" * 200)], PAGES)
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in warc.archived(again).collect()) == {
        (1, "response", None): 2, (None, "revisit", 1): 1}
    odd = spark.createDataFrame([(None, "u", "z" * 200), (None, "u", "z" * 200), (5, "http://a/\r\nX: \n%0A", "s")], PAGES)
    assert Counter((r.page_id, r.url, r.record_type) for r in warc.archived(odd).collect()) == {
        (None, "u", "response"): 2, (5, "http://a/\r\nX: \n%0A", "response"): 1}


@pytest.mark.parametrize("change", ["offset = offset + 1", "length = length - 1", "record_id = 'urn:page:0'", None])
def test_archives_are_read_by_their_index(spark, tmp_path, change):
    folder = str(tmp_path / "archives")
    index = warc.write_bundles(pages(spark).limit(40), folder, frame_bytes=20_000)
    assert warc.read_bundles(spark, folder, index).count() == 40
    if change is None:
        wrong = index.where("offset > 0")
    else:
        column, value = change.split(" = ")
        wrong = index.withColumn(column, F.expr(value))
    with pytest.raises(Exception, match="index|hold|record"):
        warc.read_bundles(spark, folder, wrong).collect()


# --- url filters ----------------------------------------------------------------------------

def judged_by_hand(captures, entries):
    def patterns(url):
        found = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)[^/?#]*([^?#]*)", url or "")
        if not found or not found[1]:
            return []
        host, path = found[1].lower(), [s for s in found[2].split("/") if s]
        labels = host.split(".")
        return [".".join(labels[k:]) for k in range(len(labels))] + ["/".join([host, *path[:k + 1]]) for k in range(len(path))]

    out = {}
    for c, url, at in captures:
        best = None
        for p in patterns(url):
            ruling = max(((t, e, a) for e, q, a, t in entries if q == p and t is not None and at is not None and t <= at), default=None)
            if ruling and ruling[2] != "remove":
                best = max(best or ((-1,),), ((("/" in p) * (1 << 20) + len(p), p), ruling[1], ruling[2]))
        out[c] = (best[1], best[0][1], best[2], best[2] == "block") if best else (None, None, None, False)
    return out


@pytest.mark.parametrize("bucket_seconds", [7, 100, 10_000])
def test_url_filters(spark, bucket_seconds):
    urls = ["http://a.b.c/x/y?q", "https://u:p@A.B.C:80/x", "http://c", "http://other/", None, "nonsense", "http://b.c//x//z#f", "http://a.b.c"]
    patterns = ["c", "b.c", "a.b.c", "a.b.c/x", "a.b.c/x/y", "b.c/x", "b.c/x/z", "none", None]
    captures = [(k, urls[k % len(urls)], (k * 37) % 400 if k % 11 else None) for k in range(300)]
    entries = [(k, patterns[k % len(patterns)], ("block", "allow", "remove")[(k * k) % 3], (k * 53) % 390 if k % 13 else None) for k in range(120)]
    got = url_filters.judged(spark.createDataFrame(captures, "capture_id long, url string, at long").withColumn("bucket", F.lit(0)),
                             spark.createDataFrame(entries, "entry_id long, pattern string, action string, at long"), bucket_seconds).collect()
    assert {r.capture_id: (r.entry_id, r.pattern, r.action, r.blocked) for r in got} == judged_by_hand(captures, entries)


def test_url_filters_of_nothing(spark):
    captures = spark.createDataFrame([(1, "http://a", 5), (1, "http://a", 5)], "capture_id long, url string, at long")
    entries = spark.createDataFrame([], "entry_id long, pattern string, action string, at long")
    assert [tuple(r) for r in url_filters.judged(captures, entries).select("capture_id", "blocked").collect()] == [(1, False)]
    assert url_filters.judged(captures.limit(0), entries).count() == 0


def test_url_filters_use_no_python(spark):
    plan = queries.op8_url_filters(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# --- mix ------------------------------------------------------------------------------------

@pytest.mark.parametrize("shares", [{"a": 1}, {"a": 1, "b": 1, "c": 1}, {"a": 5, "b": 3, "c": 2}, {"a": 97, "b": 2, "c": 1}, {"a": 7, "b": 7, "c": 13, "d": 1}])
def test_period_never_deviates_by_a_block(shares):
    order, q = mixing.period(shares), sum(shares.values())
    assert Counter(order) == shares
    for t in range(1, q + 1):
        done = Counter(order[:t])
        assert all(abs(done[s] - t * a / q) < 1 for s, a in shares.items())


def test_phases_use_every_block_once():
    shares, blocks = {"a": 5, "b": 3, "c": 2}, {"a": 23, "b": 40, "c": 1}
    plan, seen, at = mixing.phases(blocks, shares), defaultdict(list), {}
    for number, (start, length, used, slots) in enumerate(plan):
        ends = plan[number + 1][2] if number + 1 < len(plan) else {}
        for s, own in slots.items():
            for b in range(used[s], ends.get(s, blocks[s])):
                seen[s].append(b)
                at[s, b] = start + (b - used[s]) // len(own) * length + own[(b - used[s]) % len(own)]
    assert {s: len(b) for s, b in seen.items()} == blocks and all(b == list(range(len(b))) for b in seen.values())
    assert sorted(at.values()) == list(range(sum(blocks.values())))  # every slot holds one block


def test_mix(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("slot", F.lit("x")).withColumn(
        "source", F.when(F.col("doc_id") % 50 == 0, None).otherwise(F.col("source")))
    shares = {"src0": 5, "src1": 3}
    options = mixing.Options(block_docs=4, piece_docs=50)
    got = mixing.mixed(docs, shares, options=options).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    by_slot = defaultdict(list)
    for r in got:
        by_slot[r.slot].append(r)
    assert sorted(by_slot) == list(range(len(by_slot)))
    for rows in by_slot.values():  # a slot is one block of one source, in order
        assert len({(r.source, r.block) for r in rows}) == 1 and sorted(r.place_in_block for r in rows) == list(range(len(rows)))
    phase = [rows[0] for _, rows in sorted(by_slot.items()) if rows[0].phase == 0]
    sources = {r.source for r in got}
    total = sum(shares.get(s, 1) for s in sources)
    for t in range(1, len(phase) + 1):
        done = Counter(r.source for r in phase[:t])
        assert all(abs(done[s] - t * shares.get(s, 1) / total) < 1 for s in sources)
    assert mixing.mixed(docs.limit(0)).count() == 0
    again = mixing.mixed(docs.repartition(7), shares, options=options)
    assert {(r.doc_id, r.slot) for r in again.collect()} == {(r.doc_id, r.slot) for r in got}
    with pytest.raises(ValueError):
        mixing.mixed(docs, {"src0": 0})


# --- queries and pipeline -------------------------------------------------------------------

@pytest.mark.parametrize("name", ["op1_exact_dedup", "op8_url_filters", "op10_decontaminate"])
def test_query_equals_its_sql(spark, name):
    from tidewatch.llm.oracles import ORACLES

    assert compare(spark, duck(SF), name, queries.QUERIES[name], ORACLES[name], SF) == "ok"


def test_pipeline_stages(spark):
    from test_text_operators import contaminated_by_hand, exact_by_hand, near_by_hand

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontamination", "mixing"]
    stages = dict(corpus_pipeline.STAGES)

    def rows(df):
        return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]

    clear = stages["language_id"](spark, docs, SF)
    assert clear.schema == docs.schema and clear.count() > 0.9 * docs.count()
    single = stages["exact_dedup"](spark, docs, SF)
    assert {d for d, _ in rows(single)} == {d for d, v in exact_by_hand(rows(docs)).items() if v[2]}
    apart = stages["near_dedup"](spark, single, SF)
    assert {d for d, _ in rows(apart)} == {d for d, v in near_by_hand(rows(single), 5, 80).items() if v[2]}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = stages["decontamination"](spark, apart, SF)
    assert {d for d, _ in rows(clean)} == {d for d, v in contaminated_by_hand(rows(apart), bench).items() if not v[4]}
    mix = stages["mixing"](spark, clean, SF)
    assert sorted(r.doc_id for r in mix.collect()) == sorted(d for d, _ in rows(clean))
    assert corpus_pipeline.ORACLE_SQL is None
    whole = corpus_pipeline.run(spark, SF).collect()
    assert 0 < len(whole) <= docs.count() and len({r.doc_id for r in whole}) == len(whole)


def test_extraction_travels_by_value():
    """Workers that cannot import the package run what the driver pickled."""
    import pickle
    import subprocess
    import sys

    from pyspark import cloudpickle

    code = cloudpickle.dumps(extract._extract)
    run = ("import pickle, sys, pyarrow as pa; f = pickle.loads(sys.stdin.buffer.read());"
           "b = pa.RecordBatch.from_pydict({'page_id': [1], 'url': ['u'], 'html': ['<p class=a>x</p><p>y'], 'low': pa.array([None], pa.list_(pa.int64()))});"
           "print(next(iter(f([b]))).column(2).to_pylist())")
    done = subprocess.run([sys.executable, "-c", run], input=code, capture_output=True, cwd="/", timeout=60)
    assert done.stdout.decode().strip() == "['x\\ny']", done.stderr.decode()[-500:]
    assert pickle.loads(code)

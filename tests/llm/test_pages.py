"""Page text, wrappers, line quality and the pipeline."""

import html
import re

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from railwatch.llm import html as pages
from railwatch.llm import quality
from railwatch.llm.blocks import slabs
from railwatch.llm.queries import QUERIES
from tests.llm.samples import no_docs, odd_docs
from tests.llm.test_duplicates import all_pairs

SF = "/root/testdata/sf0.001"

CASES = [
    ("", ""), ("plain text < 5 &lt;b&gt;", "plain text < 5 <b>"),
    ("<div class='menu'><a href=x>Home</a></div><div id=content><p>Hello &amp; <b>wor</b>ld<br>again&nbsp;x<p>Second<ul><li>a<li>b</ul></div>"
     "<div class=cookie-notice>We use cookies</div><footer>f</footer>", "Hello & world again x\nSecond\na\nb"),
    ("<header><h1>Site</h1></header><main><article><header><h2>Title</h2></header><p>One<article class='comment'><p>bad</article>"
     "<section id=comments><p>c</section></article><aside>x</aside></main>", "Title\nOne"),
    ("<nav><ul><li>unclosed<article><p>real</p></article>", "real"), ("<script>if(a<b){}</script>t<style>p{}</style>u<!-- c -->v", "tuv"),
    ("<p>cut <a href=\"x", "cut"), ("<article><p class='ad'>buy<p>real text</article>", "real text"),
    ("<div><p>x</p><form><input name=a>Your mail<button>ok</button></form><div class='ad-slot'>buy</div><p>y</p></div>", "x\ny"),
    ("<p>a</p><noscript>enable</noscript><pre>x\n  y</pre>", "a\nx y"), ("<p hidden>no</p><div style='display: none'>no</div>yes", "yes"),
    ("<article><p>a&#233;&#x4e2d;&unknown;</p></article>", "aé中&unknown;"),
    ("<article>short</article><article><p>the long one, with text</article>", "short\nthe long one, with text"),
    ("<body><form id=aspnetForm><input type=hidden name=v><div class='cookie-notice'>We use cookies</div><p>the body of a page in a form</p></form></body>",
     "the body of a page in a form"),
    ("<div class='social studies'><p>what pupils learn</p></div><div class=social>share</div>", "what pupils learn"),
    ("<div id='hidden-gems'><p>places to see</p></div><form>Your name<input></form>", "places to see"),
    ("<p>short</p><div class=comments><p>a reader who wrote much more than the page says</p></div>", "short"),
]


@pytest.mark.parametrize(("markup", "text"), CASES)
def test_main_text(markup, text):
    assert pages.main_text(pages.read(markup), []) == text


def test_query_extracts_every_article(spark):
    markup = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op1_wrapper_main_text"](spark, SF).collect()
    assert len(rows) == len(markup)
    for r in rows:
        inner = re.search("<article>(.*?)(?:</article>|$)", markup[r.page_id], re.S)[1].replace("<br>", " ")
        blocks = (" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def wrapper(*markups):
    found = pages.wrapper_of(pages.said_by(pages.read(markups[0])))
    for m in markups[1:]:
        found = pages.merge(found, pages.wrapper_of(pages.said_by(pages.read(m))))
    return found


def test_wrappers_have_groups_and_options():
    found = wrapper("<ul><li>a<li>b</ul><h1>x</h1>", "<ul><li>a</ul><div>new</div><h1>y</h1>", "<ul><li>a<li>c<li>d</ul><h1>z</h1>")
    shape = [("".join(i[0]), i[1]) for i in found]
    assert ("+li#", 3) in shape and ("div", 1) in shape and ("h1", 3) in shape
    # The same wrapper whichever half is merged first.
    a, b = ["<p>1</p><div>q</div>", "<p>2</p><p>3</p><div>q</div>"], ["<p>4</p>", "<p>5</p><div>q</div>"]
    left = pages.merge(wrapper(*a), wrapper(*b))
    assert [(i[0], i[1]) for i in left] == [(i[0], i[1]) for i in pages.merge(wrapper(*b), wrapper(*a))]


def test_template_slots_go_and_copies_stay(spark):
    page = "<body><section>Members get this daily</section><section><p>{}</p></section></body>"
    rows = [(i, "http://a.net/x", page.format(f"story {i} " * 20)) for i in range(6)]
    rows += [(10 + i, "http://b.net/x", page.format("one copied story " * 20)) for i in range(6)]
    rows += [(20, None, "<p>t</p>"), (21, "http://c.net", None), (22, "", ""), (None, "http://a.net/x", page.format("more"))]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in pages.extract(df).collect()}
    assert len(got) == len(rows)
    assert got[3] == " ".join(["story 3"] * 20) and got[None] == "more"
    assert got[12].startswith("Members get this daily\none copied")
    assert (got[20], got[21], got[22]) == ("t", "", "")
    assert pages.extract(df.where("false")).collect() == []


@pytest.mark.parametrize("size", [10, 9_000, 300_000])
def test_quoted_values_of_any_length(size):
    value = "<p>not &gt; text</p>" * (size // 20 + 1)
    for quote in "\"'":
        for tag in ("div data-json", "a href", "iframe srcdoc"):
            markup = f"<article><p>one</p><{tag}={quote}{value}</iframe>{quote} class=x>{'</iframe>' if 'iframe' in tag else ''}<p>two</p></article>"
            assert pages.main_text(pages.read(markup), []) == "one\ntwo"
    # Stray quotes open nothing, nor does one that is not closed.
    strays = f"<p class='a''>it's</p><p don't>{'two ' * (size // 4)}</p><p title=\"x>three</p>"
    assert pages.main_text(pages.read(strays), []).split() == ["it's", *["two"] * (size // 4), "three"]


def test_body_beside_a_small_article():
    markup = "<body><nav>{0}</nav><div id=content><p>{1}</p></div><article>teaser</article><footer>{0}</footer></body>"
    body = " ".join(["the long body"] * 9)
    assert pages.main_text(pages.read(markup.format("Home " * 50, body)), []) == body + "\nteaser"
    assert pages.main_text(pages.read(markup.format("Home " * 50, "by us")), []) == "teaser"


def texts_of(spark, rows):
    df = spark.createDataFrame([(i, f"http://{host}/{i}", markup) for i, (host, markup) in enumerate(rows)], "page_id long, url string, html string")
    return [r.text for r in sorted(pages.extract(df).collect(), key=lambda r: r.page_id)]


def test_template_is_on_nearly_all_distinct_contents(spark):
    story = "<body><section>Join us</section><h2>{}</h2><section><p>{}</p></section></body>"
    # Some copies of one story with an element of its own, and a heading that some pages share.
    copied = story.replace("<p>", "<blockquote>Quoted words</blockquote><p>").format("Alone", "one copied story " * 9)
    rows = [("a.net", story.format("Summary" if i < 6 else f"Head {i}", f"story {i} " * 9)) for i in range(20)] + [("a.net", copied)] * 5
    # Template text that is longer than the rest, and is missing on one page of twelve.
    rows += [("b.net", story.replace("Join us", "Join us today " * 40).format(f"Head {i}", f"news {i}")) for i in range(11)]
    rows += [("b.net", story.replace("Join us", "Closed").format("Head 11", "news 11"))]
    # What every main region says stays.
    rows += [("c.net", f"<div>Join us</div><main><h2>Summary</h2><p>item {i}</p></main>") for i in range(5)]
    got = texts_of(spark, rows)
    assert got[0] == "Summary\n" + " ".join(["story 0"] * 9) and got[7].startswith("Head 7\nstory 7")
    assert got[20:25] == ["Alone\nQuoted words\n" + " ".join(["one copied story"] * 9)] * 5
    assert got[25] == "Head 0\nnews 0" and got[36] == "Closed\nHead 11\nnews 11"
    assert got[37:] == [f"Summary\nitem {i}" for i in range(5)]


def test_pages_of_very_many_items(spark):
    names = [a + b for a in "abcdefghijklmnopqr" for b in "abcdefghijklmnopqr"]
    shared = "".join(f"<div class='k{n}'>Shared {n}</div>" for n in names)
    rows = [("a.net", f"<body>{shared}<section><p>{f'story {i} ' * 900}</p></section><div class=last>Our office</div></body>") for i in range(5)]
    assert texts_of(spark, rows) == [" ".join([f"story {i}"] * 900) for i in range(5)]
    one, two = (wrapper(f"<body>{shared}<p>{i}</p></body>") for i in range(2))
    assert len(pages.merge(one, two)) == len(one) > 900


def plain_marginals(evidence, step):
    """All label sequences, summed."""
    n = len(evidence)
    total, good = 0.0, np.zeros(n)
    for code in range(2**n):
        labels = [(code >> t) & 1 for t in range(n)]
        weight = np.exp(sum(e for e, y in zip(evidence, labels, strict=True) if y) + sum(step[a, b] for a, b in zip(labels[:-1], labels[1:], strict=True)))
        total += weight
        good += weight * np.array(labels)
    return good / total, np.log(total)


def test_forward_backward_equals_all_sequences():
    rng = np.random.default_rng(4)
    lines, step = np.array([3, 1, 6, 2]), rng.normal(size=(2, 2))
    evidence = rng.normal(size=lines.sum())
    got, _, total = quality._forward_backward(evidence, lines, step)
    at = 0
    sums = []
    for n in lines:
        want, log = plain_marginals(evidence[at:at + n], step)
        assert np.allclose(got[at:at + n], want)
        sums.append(log)
        at += n
    assert np.allclose(sorted(sums), sorted(total))


def test_lines_are_split_like_text():
    texts = ["a\nb\n", "", "x", "\n", "é!\n\nlast"]
    slab = next(slabs(pa.array(texts)))
    lines, size, features = quality.line_features(slab)
    assert lines.tolist() == [t.count("\n") + 1 for t in texts]
    assert size.sum() == sum(len(t.encode()) for t in texts)
    assert features.shape == (lines.sum(), quality.LINE_FEATURES) and np.isfinite(features).all()
    alone = np.concatenate([quality.line_features(next(slabs(pa.array([t]))))[2] for t in texts])
    assert np.allclose(features, alone)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op6_line_crf_quality"](spark, sf).collect() if r.held_out and labels.get(r.doc_id) is not None]
    assert sum(r.predicted == labels[r.doc_id] for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_odd_rows_are_scored(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (6, None), (8, 1), (None, 0), (7, 5)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    rows = quality.scores(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.good_documents(docs, model, 0.0).columns == docs.columns
    untaught = quality.train(docs, labels.where("false"))
    assert {r.score for r in quality.scores(docs, untaught).collect()} == {0.5}
    assert quality.scores(no_docs(spark), model).collect() == []


def test_stages_do_what_they_say(spark, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    states = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, states[-1], SF).write.parquet(str(tmp_path / name))
        states.append(spark.read.parquet(str(tmp_path / name)))
    for state in states[1:-1]:
        assert state.columns == docs.columns
    clean, apart, mix, packed = ([r for r in s.collect()] for s in states[1:])
    kept = {r.doc_id for r in clean}
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in kept for i in good) >= 0.98 * len(good) and sum(i in kept for i in bad) <= 0.1 * len(bad)
    want = {c for _, c in all_pairs([(r.doc_id, r.text) for r in clean], 5).values()}
    assert {r.doc_id for r in apart} == want and len(apart) == len(want)
    assert {r.doc_id for r in mix} <= want and len(mix) > len({r.doc_id for r in mix}) > 0
    assert sum(r.piece == 0 for r in packed) == len(mix)
    assert corpus_pipeline.run(spark, SF).count() == len(packed)


def site(k, menu, body, extra=""):
    """A page without telling names: fixed slots before and after the body, one of them only on some pages."""
    return f"<body><div>{menu}</div>{extra}<section>{''.join(f'<p>{b}</p>' for b in body)}</section><div><span>Our office</span></div></body>"


@pytest.mark.parametrize("parts", [(1024, 32), (3, 2)])
def test_wrappers_decide_where_no_name_does(spark, monkeypatch, parts):
    """The text of pages without article or names against a count of what stands before and after the body."""
    monkeypatch.setattr(pages, "PARTS", parts)
    rng = np.random.default_rng(6)
    rows, want = [], []
    for k in range(60):
        body = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"], 9)) + f" {k}" for _ in range(1 + k % 4)]
        extra = f"<h2>Note {k}</h2>" if k % 5 == 0 else ""
        menu = "Start, shop, contact" if k != 17 else "Closed today"
        rows.append(("plain.net", site(k, menu, body, extra)))
        want.append("\n".join(([menu] if k == 17 else []) + ([f"Note {k}"] if extra else []) + body))
    assert texts_of(spark, rows) == want
    # With fewer than four contents nothing can be told.
    few = texts_of(spark, [("small.net", site(k, "Start", [f"text {k}"])) for k in range(3)])
    assert few == [f"Start\ntext {k}\nOur office" for k in range(3)]


def test_wrapper_of_a_host_counts_each_content_once(spark):
    rows = [(f"http://a.net/{i}", site(i, "Menu", [f"text {i % 7}"])) for i in range(40)]
    df = spark.createDataFrame([("a.net", m) for _, m in rows] + [("a.net", None), ("a.net", "")], "host string, html string")
    found = pages.wrappers(df).collect()
    assert [(r.host, r.contents) for r in found] == [("a.net", 7)]
    import pickle

    items = pickle.loads(found[0].wrapper)
    said = [(w[0], w[1], sorted(w[2].values())) for w in items if w[2]]
    assert [(n, texts) for _, n, texts in said] == [(7, [7]), (7, [1] * 7), (7, [7])]


def test_frequent_texts_survive_any_merge():
    rng = np.random.default_rng(3)
    parts = []
    for _ in range(50):
        part = {}
        for _ in range(20):
            part = pages._summed(part, {int(rng.integers(1_000)) if rng.random() < 0.08 else -1: 1})
        parts.append(part)
    total = {}
    for part in parts:
        total = pages._summed(total, part)
    assert len(total) <= pages.TEXTS and total[-1] >= 0.9 * 1_000 - 10

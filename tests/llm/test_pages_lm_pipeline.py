import hashlib
import html
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from loadcast.llm import lm, mixing, pagetext, pieces, quality

from .fixtures import awkward, awkward_rows, clashing, empty
from .test_joins import brute_join
from .test_rules_lines_chunks import brute_lines, brute_quality

SF = "/root/testdata/sf0.001"


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


def test_page_extraction_equals_the_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    out = {r.page_id: r for r in entry.queries()["op2_html_extraction"](spark, SF).collect()}
    rows = pages.collect()
    assert len(out) == len(rows)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<br>|</?b>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        want = "\n".join(b for b in blocks if b)
        assert (out[r.page_id].text, out[r.page_id].n_chars, out[r.page_id].url) == (want, len(want), r.url)


@pytest.mark.parametrize("body, want", [
    ("<article><header><h1>A &amp; B</h1></header><p>x&nbsp; y<br>z</p><footer>f</footer></article>", "A & B\nx y z"),
    ("<nav>m</nav><div class='cookie-notice'>c</div><article><p>a<p>b<ul><li>1<li>2</ul></article><aside>s</aside>", "a\nb\n1\n2"),
    ("<article><p>t</p><div id=comments><p>c</p></div><form><p>f</p></form><div class='ad'>x</div><p>u</p></article>", "t\nu"),
    ("<header><div>h<article><p>kept</p></article>", "kept"),
    ("<main><h2>t</h2><p>a &lt;b&gt; &#233;&#x1F600;</p></main><p>out</p>", "t\na <b> é😀"),
    ("<article><script>var a='<p>no</p>'</script><style>p{}</style><!-- <p>no</p> --><p>yes", "yes"),
    ("<article><p title='a > b' class=\"with-sidebar\">q</p><p hidden>no</p><p style='display: none'>no</p></article>", "q"),
    ("", ""), ("<article></article>", ""),
    ("<p data-x=don't>one</p><p>it's two</p><p>three</p>", "one\nit's two\nthree"),
    ("<p title='open>one</p><p>two</p>", "one\ntwo"),
    ("<main><h1>Title</h1><article><p>x</p></article></main><p>out</p>", "Title\nx"),
    ("<article class=comment>no</article><article class='advert'>no</article><article><p>yes</p></article>", "yes"),
    ("<article><p>long story text</p></article><article><h3><a href=x>Read this other</a></h3></article>", "long story text"),
    ("<article><h3><a href=x>only links</a></h3></article>", "only links"),
    *[(f"<article><p class='{c}'>in</p><p id={c}>too</p></article>", "in\ntoo")
      for c in "social-science share-price notice-period search-results-explained login-stats no-sidebar".split()],
    *[(f"<article><p>in</p><div class='x {c}'>out</div></article>", "in")
      for c in "site-footer ad-slot-2 comment_list cookie-notice related-articles newsletter-box share-buttons".split()],
    ("<article><p class=ad>x<p>story</article>", "story"),
    ("<article><div>a <span class='ad'>x</div><p>story</article>", "a\nstory"),
    ("<article>a <svg/>b<svg><title>t</title><path/></svg> c 1 < 2</article>", "a b c 1 < 2"),
    ("<div>story</div><div class=comments><article>c</article></div>", "story"),
    ("<article><div>a</div></div><p>b</article>", "a\nb"),
])
def test_lines_of_a_page(body, want):
    assert pagetext.main_text(pagetext.read_lines(page(body))) == want


def test_broken_markup_is_read_once():
    for piece in ("<a ", '<a "b ', "<", "<!--", '<a x="', "<p class=ad>", "<article>", "<li>", "<b></i>"):
        begun = time.process_time()
        pagetext.read_lines((piece * 2**20)[:2**20])
        assert time.process_time() - begun < 10  # quadratic reading takes hours
    many = "<article>" * 50_000 + "</main>" * 50_000 + "</section>" * 50_000
    assert pagetext.read_lines(many + "x") == [("x", pagetext.ARTICLE)]


def brute_common(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    return best[0][0]


def test_common_lines_are_a_longest_subsequence():
    rng = np.random.default_rng(4)
    for _ in range(300):
        a, b = (rng.integers(0, 6, rng.integers(0, 14)).tolist() for _ in range(2))
        got = sorted(pagetext.common(a, b))
        assert len(got) == brute_common(a, b)
        it = iter(b)
        assert all(x in it for x in (a[i] for i in got))


def test_common_lines_of_long_pages(monkeypatch):
    rng = np.random.default_rng(5)
    pairs = [[rng.integers(0, 5, rng.integers(0, 60)).tolist() for _ in range(2)] for _ in range(60)]
    whole = [len(pagetext.common(a, b)) for a, b in pairs]
    monkeypatch.setattr(pagetext, "TABLE_BITS", 40)  # halved again and again
    for (a, b), n in zip(pairs, whole):
        got = sorted(pagetext.common(a, b))
        it = iter(b)
        assert len(got) == n == brute_common(a, b) and all(x in it for x in (a[i] for i in got))
    monkeypatch.undo()
    repeated = rng.integers(0, 2, 8000).tolist()  # two lines, thousands of times each
    assert len(pagetext.common(repeated, repeated[1:] + [7])) == 7999


def test_articles_in_frames_behind_the_main_article_are_no_text():
    main = "<header><div>h<article><p>story</p></article></div></header>"
    for frame in ("<section class=comments><article><p>reader</p></article><article><p>other</p></article></section>",
                  "<div class='related'><article><p>teaser</p></article></div>", "<nav><article>t</article></nav>"):
        assert pagetext.main_text(pagetext.read_lines(main + frame + "<article><p>more</p></article>")) == "story\nmore"


def test_pages_without_article_lose_shared_lines(spark):
    frame = "<div>Site name</div><div>{}</div><div>All rights reserved</div>"
    rows = [(k, f"http://h{k % 2}.example/p/{k:03}", page(frame.format(f"story {k}"))) for k in range(30)]
    rows += [(100 + k, f"http://h0.example/p/004?view={k}", rows[4][2]) for k in range(3)]  # copies of a page
    rows += [(200, None, page("<p>alone</p>")), (201, "no url", page("<p>alone</p>")), (202, "http://h0.example/p/x", None),
             (203, "http://h0.example/p/y", ""), (204, "http://only.example/", page("<p>single page</p>"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for parts in (1, 7):
        out = {r.page_id: r.text for r in pagetext.extract_pages(df.repartition(parts).selectExpr("*", "1 as k1", "'x' as host")).collect()}
        assert all(out[k] == f"story {k}" for k in range(30)) and all(out[100 + k] == "story 4" for k in range(3))
        assert (out[200], out[201], out[202], out[203], out[204]) == ("alone", "alone", "", "", "single page")
    assert pagetext.extract_pages(df.limit(0)).count() == 0


def test_large_frames_and_copies_are_told_apart(spark):
    menu = "".join(f"<li>menu {k}" for k in range(30))
    body = "<ul>" + menu + "</ul><p>own {0} a</p><p>own {0} b</p><p>own {0} c</p>"
    rows = [(k, f"http://h/{k}", page(body.format(k))) for k in range(4)]
    rows += [(10 + k, f"http://h/copy/{k}", rows[2][2]) for k in range(3)]
    rows += [(20, "http://g/1", page("<p>a</p><p>b</p>")), (21, "http://g/2", page("<p>a</p><p>x</p><p>b</p>"))]
    out = {r.page_id: r.text for r in pagetext.extract_pages(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(4):
        assert out[k] == f"own {k} a\nown {k} b\nown {k} c"
    assert all(out[10 + k] == out[2] for k in range(3))
    assert (out[20], out[21]) == ("a\nb", "x")  # the longer version says nothing about the shorter


def test_differencing_equals_brute_force(spark):
    # Lines come in one order and once a page, so the lines two pages share are
    # their only longest common subsequence.
    rng = np.random.default_rng(6)
    rows, sites = [], {}
    for k in range(160):
        host = f"h{min(k % 7, 2)}.example"
        path, rest = (f"/{rng.integers(0, 60):02}", f"?v={k}") if k % 3 else (f"/{k % 60:02}/{k}", "")
        marks = [("<div>{}</div>", 0), ("<h1>{}</h1>", 1), ("<main>{}</main>", 2), ("<article>{}</article>", 3)]
        kinds = marks[:1] if k % 4 == 0 else marks[:2] if k % 4 == 1 else marks[:3] if k % 4 == 2 else marks
        lines = [(f"line {n}", *kinds[rng.integers(0, len(kinds))]) for n in sorted(rng.choice(14, rng.integers(0, 9), replace=False))]
        rows.append((k, f"http://{host}{path}{rest}", page("".join(form.format(t) for t, form, _ in lines))))
        best = max((m for _, _, m in lines), default=0)
        best = 0 if best == 1 else best
        states = tuple(2 if not best or best > m > 0 else 1 if m == best else 0 for _, _, m in lines)
        key = (tuple(t for t, _, _ in lines), states)
        pages = sites.setdefault(host, {})
        if lines:
            pages[key] = min(pages.get(key, ("~", "")), (path, rest))
        rows[-1] += (host, key)
    want = {}
    for k, _, _, host, key in rows:
        ordered = sorted(sites[host], key=lambda x: sites[host][x])
        at = ordered.index(key) if key in ordered else 0
        gone = set()
        for n in (at - 1, at + 1):
            if key[0] and 0 <= n < len(ordered) and not set(key[0]) <= set(ordered[n][0]):
                gone |= set(key[0]) & set(ordered[n][0])
        want[k] = "\n".join(t for t, s in zip(*key) if s == 1 or s == 2 and t not in gone)
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    for parts in (1, 5):
        out = {r.page_id: (r.text, r.n_chars) for r in pagetext.extract_pages(df.repartition(parts)).collect()}
        assert out == {k: (t, len(t)) for k, t in want.items()}
    assert len({r[4] for r in rows}) > 100 and sum(t.count("\n") for t in want.values()) > 50


# --- language model ----------------------------------------------------------------

def test_gradient_matches_differences():
    rng = np.random.default_rng(1)
    n = 3000
    lexicon = lm.Lexicon(rng.integers(0, 50, n).astype(float), rng.random(n) < 0.5)
    p = {k: v.astype(np.float64) for k, v in lm.initial(lexicon).items()}
    texts = [rng.integers(0, n, m) for m in (1, 5, 40)]
    syms, ids, _ = lm.windows(texts, lexicon)
    share = sum(lexicon.share[t].sum() for t in texts)
    loss = lambda p: -(lm.score_windows(p, lexicon, syms, ids).sum() - share) / 46
    g = lm.gradient(p, lexicon, syms, ids)
    for k in p:
        at = np.unravel_index(np.argmax(np.abs(g[k])), g[k].shape)
        up, down = ({a: b.copy() for a, b in p.items()} for _ in range(2))
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        assert abs((loss(up) - loss(down)) / 2e-5 - g[k][at]) < 1e-5 + 1e-4 * abs(g[k][at])


def test_scores_are_causal_and_sum_to_one():
    rng = np.random.default_rng(2)
    n = 1200
    lexicon = lm.Lexicon(rng.integers(0, 9, n).astype(float), rng.random(n) < 0.5)
    p = lm.initial(lexicon)
    prefix = rng.integers(0, n, 30)

    def score(text):
        syms, ids, owner = lm.windows([np.array(text)], lexicon)
        return lm.score_windows(p, lexicon, syms, ids).sum()

    whole = score(prefix)
    total = sum(math.exp(score([*prefix, i]) - whole) for i in range(n))
    assert abs(total - 1) < 1e-3  # also: what follows does not change what went before
    syms, ids, _ = lm.windows([prefix], lexicon)
    assert Counter(ids[ids >= 0].tolist()) == Counter(prefix.tolist())  # each id once


def plain_attention(p, lexicon, text):
    """Log probabilities of a text's ids, one after the other, without tables."""
    symbols, out = [lm.START], []
    for i in text:
        span = symbols[-lm.SPAN:]
        e = p["E"][span]
        q, k, v = e[-1] @ p["Wq"] / math.sqrt(lm.WIDTH), e @ p["Wk"], e @ p["Wv"]
        s = k @ q + p["bias"][:len(span)][::-1]
        a = np.exp(s - s.max())
        h = np.tanh(a @ v / a.sum() + e[-1] @ p["Wr"])
        group, member = divmod(int(lexicon.cls[i]), lm.MEMBERS)
        z = h @ p["G"] + p["g0"]
        m = h @ p["M"][group] + p["m0"][group]
        out.append(lexicon.share[i] + z[group] - np.log(np.exp(z).sum()) + m[member] - np.log(np.exp(m).sum()))
        symbols.append(int(lexicon.cls[i]))
    return out


def test_batched_windows_equal_plain_attention():
    rng = np.random.default_rng(4)
    n = 2000
    lexicon = lm.Lexicon(rng.integers(0, 50, n).astype(float), rng.random(n) < 0.5)
    p = {k: v + rng.normal(size=v.shape) * 0.3 for k, v in lm.initial(lexicon).items()}
    texts = [rng.integers(0, n, m) for m in (1, lm.STEP - 1, lm.STEP, lm.STEP + 1, 5 * lm.STEP + 7)]
    syms, ids, owner = lm.windows(texts, lexicon)
    got = np.bincount(owner, lm.score_windows(p, lexicon, syms, ids))
    assert np.allclose(got, [sum(plain_attention(p, lexicon, t)) for t in texts], rtol=1e-6)


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm, "LANE_WORDS", 3_000)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    runs = [{r.doc_id: r.score for r in lm.score_documents(docs.repartition(n)).collect()} for n in (1, 6, 50)]
    assert len(runs[0]) == docs.count()
    for run in runs[1:]:
        assert max(abs(run[k] - x) / abs(x) for k, x in runs[0].items()) < 1e-3


def brute_base(rows):
    words = lambda t: (t or "").encode().translate(lm._FOLD).split() + [b""]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    counts = Counter(w for i, t, *_ in rows if not held(i) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    total = n + 0.1 * (v + 1)
    return sorted(((i is None, i or 0, held(i), len(words(t)), sum(counts[w] > 0 for w in words(t)), n,
                    round(sum(math.log10((counts[w] + 0.1) / total) for w in words(t)), 5)) for i, t, *_ in rows))


@pytest.mark.parametrize("head", [lm.HEAD, 40])
def test_base_score_matches_brute_force(spark, monkeypatch, head):
    monkeypatch.setattr(lm, "HEAD", head)
    out = lm.score_documents(clashing(spark).repartition(3)).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in out)
    want = brute_base(awkward_rows())
    assert [x[:-1] for x in got] == [x[:-1] for x in want]
    assert all(abs(a[-1] - b[-1]) < 1e-3 for a, b in zip(got, want))
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)


def test_scoring_an_empty_table(spark):
    assert lm.score_documents(empty(spark)).count() == 0


def test_training_improves_held_out_text(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    trained = lm.score_documents(docs).where("held_out").toPandas()
    monkeypatch.setattr(lm, "fit", lambda training, lexicon, path: lm.flat(lm.initial(lexicon)))
    untrained = lm.score_documents(docs).where("held_out").toPandas()
    # The untrained model is the unigram model of subword ids.
    assert len(trained) > 50 and trained.score.sum() > 0.85 * untrained.score.sum()


# --- pipeline ------------------------------------------------------------------------

def test_pipeline_matches_a_brute_force_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    at = {c: k for k, c in enumerate(docs.columns)}

    def passes(text):
        if brute_quality(text)["base_failed"]:
            return False
        return kept[text]

    kept = {r.text: r.kept for r in quality.judge(docs).select("text", "kept").collect()}
    rows = [r for r in rows if passes(r[at["text"]])]
    pairs = [(r[at["doc_id"]], r[at["text"]]) for r in rows]
    texts = {i: t for i, _, _, t in brute_lines(pairs)}
    reps = {i for i, _, c in brute_join([(i, texts[i]) for i, _ in pairs]) if i == c}
    left = [r for r in rows if r[at["doc_id"]] in reps]
    frame = spark.createDataFrame(left, docs.schema)
    times = {r.doc_id: r.n_copies for r in mixing.mix(frame).select("doc_id", "n_copies").collect()}
    model = pieces.load(pieces.default_model())
    want = Counter()
    for r in left:
        i = r[at["doc_id"]]
        ids = model.encode(texts[i])
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
             hashlib.sha256(model.decode(ids).encode()).hexdigest()] += times.get(i, 0)
    found = corpus_pipeline.run(spark, SF).collect()
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found)
    assert got == +want
    assert all(hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest() == r.ids_sha256 for r in found)


def test_stages_handle_awkward_rows_and_empty_tables(spark):
    for make in (awkward, empty, clashing):
        docs = make(spark)
        columns = docs.columns
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, SF)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert docs.columns == columns
        docs.count()
        for _, stage in corpus_pipeline.STAGES:  # each stage by itself on the raw rows
            stage(spark, make(spark), SF).count()


def test_every_operator_is_registered_once():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()

"""Text operators: brute force, round trips, held-out accuracy, and the defined results of odd inputs."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from showledger.llm import byte_bpe, chat_format, components, exact_dedup, html_extract, jaccard_join, quality_pu, sharding, toxicity, url_filter, winnowing
from showledger.llm.queries import QUERIES

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, None, "s", None) for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and repeated texts, repeated and null ids, and columns that operators use themselves."""
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "a b"), (None, None), (4, "x" * 70_000), (5, " \n\t "), (6, "a  b")]
    extra = ["digest", "key", "ids", "raw", "win_key", "win_mark", "score", "text_key", "id"]
    return spark.createDataFrame([(i, t, None, None, None, *["z"] * len(extra)) for i, t in rows], DOCS + "".join(f", {c} string" for c in extra))


# -- 9 exact dedup ---------------------------------------------------------------

def _normal(t):
    return re.sub("[ \t-\r]+", " ", t or "")


def test_perfect_hash_is_minimal_and_total():
    for n in (0, 1, 2, 5_000):
        words = np.frombuffer(np.random.default_rng(n).bytes(32 * n), np.uint64).reshape(-1, 4)
        levels, bits = exact_dedup.perfect_hash(words)
        assert bits.sum() == n and sorted(exact_dedup.slots(words, levels, bits).tolist()) == list(range(n))
    other = np.frombuffer(np.random.default_rng(99).bytes(32 * 1000), np.uint64).reshape(-1, 4)
    assert (exact_dedup.slots(other, levels, bits) < n).all()


def test_exact_dedup_brute_force(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BUCKET_KEYS", 7)  # many buckets
    rng = random.Random(1)
    texts = [rng.choice(["a", "a b", "a\t b", None, "", " ", "c" * rng.randint(1, 4)]) for _ in range(120)]
    got = {r.doc_id: r for r in exact_dedup.dedup(docs_of(spark, texts)).collect()}
    for i, t in enumerate(texts):
        same = [j for j, u in enumerate(texts) if _normal(u) == _normal(t)]
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (min(same), len(same), i == min(same))
        assert got[i].text_sha256 == hashlib.sha256(_normal(t).encode()).hexdigest()


def test_exact_dedup_odd(spark, odd):
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.dedup(odd).collect()), key=str)
    assert len(got) == odd.count()
    assert (None, 3, 4, False) in got and got.count((3, 3, 4, True)) == 2 and (6, 3, 4, False) in got and (2, 1, 3, False) in got
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5]
    assert exact_dedup.dedup(odd.limit(0)).count() == 0 and exact_dedup.drop_copies(odd.limit(0)).count() == 0


# -- 10 URLs -----------------------------------------------------------------------

def test_url_filter(spark):
    urls = [("http://A.Org/x", "org/", "allow"), ("https://www.example.org/es/1", "example.org/es/", "block"), ("x://example.org/en/12?q#f", "example.org/en/1", "block"),
            ("http://sub.shop.COM/de/", "com/de/", "block"), ("http://b.com/fr/x", "com/fr/", "allow"), ("http://notorg/x", None, None), (None, None, None), ("no scheme/org", None, None),
            ("http://org", None, None), ("http://h.net/" + "p" * 20_000, None, None), ("http://b.com/fr/x", "com/fr/", "allow")]
    pages = spark.createDataFrame([(i, u, "h", "x", "y") for i, (u, _, _) in enumerate(urls)], "page_id long, url string, html string, host string, rule string")
    got = {r.page_id: r for r in url_filter.judge(pages).collect()}
    for i, (url, rule, verdict) in enumerate(urls):
        assert got[i].rule == rule and got[i].verdict in ("allow", "block") and (verdict is None or got[i].verdict == verdict)
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        assert got[i].host == host.lower() and got[i].path == re.match(r"[^?#]*", rest[len(host):])[0]
    assert url_filter.judge(pages.limit(0)).count() == 0
    plan = url_filter.judge(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_url_model_learns(spark):
    rows = [(f"h{i}.net", f"/{'casino' if i % 2 else 'news'}/{i}", "block" if i % 2 else "allow") for i in range(200)]
    labelled = spark.createDataFrame(rows, "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://q.net/casino/x"), (2, "http://q.net/news/x")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_filter.judge(pages, labelled).collect()} == {1: "block", 2: "allow"}


# -- 3 decontamination ---------------------------------------------------------------

def _words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def _brute_hits(texts, items):
    out = []
    for t in texts:
        w, covered, hit = _words(t), set(), set()
        for name, item in items:
            v = _words(item)
            n = min(13, len(v))
            windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1) if n else ():
                if tuple(w[i : i + n]) in windows:
                    covered |= set(range(i, i + n))
                    hit.add("" if name is None else str(name))
        ids = sorted(hit)
        out.append((len(w), len(covered), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(covered) and 20 * len(covered) >= len(w)))
    return out


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_decontamination_brute_force(spark, block):
    rng = random.Random(block)
    word = lambda: rng.choice(["a", "B", "é", "x9", "-", "zz"])
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 8, 13, 20])))) for i in range(6)] + [(2, "A, a. é b"), (None, "x9 x9 x9"), (7, None), (8, "--")]
    texts = [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(40)] + [None, "", "a", items[4][1] + " é", "A a é b"] + ["a " * 40]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in winnowing.report(docs_of(spark, texts), bench, block).collect()}
    assert [got[i] for i in range(len(texts))] == _brute_hits(texts, items)
    kept = winnowing.drop_contaminated(docs_of(spark, texts), bench, block)
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, h in enumerate(_brute_hits(texts, items)) if not h[4]]
    assert winnowing.report(docs_of(spark, texts).limit(0), bench, block).count() == 0
    assert winnowing.report(docs_of(spark, ["a"]), bench.limit(0), block).first().n_hit == 0


def test_decontamination_odd(spark, odd):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert winnowing.report(odd, bench).count() == odd.count()
    kept = winnowing.drop_contaminated(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.where("text is null or text not rlike 'a +b'").count()


# -- 2 byte-level BPE ------------------------------------------------------------------

@pytest.mark.parametrize("chunk,overlap", [(64, 16), (1 << 16, 1 << 10)])
def test_bpe_equals_tiktoken(spark, chunk, overlap):
    rng = random.Random(3)
    letters = "aB é ñ\n\t '’sS19 。中文 　\x1c\x1f!!  <|endoftext|>'re'll\r\n\U0001F600"
    texts = [None, "", "a" * 500, " " * 700, "\n" * 300 + "x"] + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 400))) for _ in range(60)]
    texts += [texts[-1], "word " * 30_000]
    want = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={})
    coder = byte_bpe.ByteBPE(spark, RANKS, public_tokenizers.PATTERN, chunk, overlap)
    got = {r.doc_id: r for r in byte_bpe.report(docs_of(spark, texts), coder).collect()}
    for i, t in enumerate(texts):
        ids = np.array(want.encode_ordinary(t or ""), dtype="<u4")
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()), i


def test_bpe_odd(spark, odd):
    coder = byte_bpe.ByteBPE(spark, RANKS, public_tokenizers.PATTERN)
    done = coder.encode(odd)
    assert done.columns == [*odd.columns, "ids_", "raw_"]
    assert done.where(F.col("raw_") != F.coalesce("text", F.lit("")).cast("binary")).count() == 0 and done.count() == odd.count()
    assert coder.encode(odd.limit(0)).count() == 0


# -- 4 sharding ------------------------------------------------------------------------

def test_shards_are_exact_and_gapless(spark):
    texts = [None, "", "é", *["same"] * 40] + [f"t{i}" for i in range(60)]
    docs = docs_of(spark, texts).repartition(7)
    got = sharding.report(docs).collect()
    assert len(got) == len(texts)
    for s in range(16):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert {sum(r.shard == s for r in got) for s in range(16)} <= {len(texts) // 16, len(texts) // 16 + 1}
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    few = sharding.report(docs.where("doc_id < 3")).collect()
    assert sorted((r.shard, r.slot) for r in few) == [(0, 0), (1, 0), (2, 0)]
    assert sharding.report(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_rows(docs.withColumn("Slot", F.lit(1)))


def test_shuffle_is_uniform():
    """Rows of a partition are spread as a uniform permutation spreads them; the matrix keeps both margins."""
    m = sharding.matrix([30, 50, 0, 20], [25, 25, 25, 25], 5)
    assert m.sum(axis=1).tolist() == [30, 50, 0, 20] and m.sum(axis=0).tolist() == [25] * 4
    seen = np.mean([sharding.matrix([40, 60], [50, 50], s)[0, 0] for s in range(400)])
    assert abs(seen - 20) < 0.6  # the standard error is 0.12


# -- 5 toxicity ------------------------------------------------------------------------

def test_grammar_tells_kinds_apart():
    m = toxicity.Matcher({})
    kind = lambda text: [i for i, x in enumerate(m.features(text)[:4]) if x]
    plain, aimed, negated, reported = range(4)
    assert kind("what a idiot") == [plain] and kind("you idiot") == [aimed] and kind("you are not an idiot") == [negated]
    assert kind('he said: "idiot"') == [reported] and kind("not here. idiot") == [plain] and kind("nothing at all") == []
    hurt = m.features("i will kill you now and you will see, kill")
    assert hurt[1] > 0 and m.features("") == [0.0] * toxicity.FEATURES


def test_composition_equals_cascade():
    machine, rng = toxicity.grammar(), random.Random(2)
    parts = machine.start
    assert isinstance(parts, tuple)
    for _ in range(200):
        state, ends = machine.start, []
        for symbol in (rng.choice(toxicity.INPUT) for _ in range(12)):
            state, out, weight = machine.step(state, symbol)
            ends.append(out)
            assert weight in (0.25, 0.5, 1.0)
        assert not any(o in ("insult", "threat") or o.startswith(("not-", "said-")) for o in ends)


def _accuracy(rows, labels):
    judged = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    return sum(a == b for a, b in judged) / len(judged), len(judged)


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"  # smaller tables hold too few toxic rows to learn the stems of four languages from
    rows = QUERIES["op5_toxicity"](spark, folder).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(folder + "/labels.parquet").collect()}
    share, n = _accuracy(rows, labels)
    assert n > 50 and share >= 0.95 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert {r.doc_id: r.held_out for r in rows} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(len(rows))}


def test_toxicity_base_rate_of_a_bounded_sample(spark):
    """3 in 10 texts with an insult and 2 in 100 others are toxic, also where the sample holds as many of each label."""
    rng = random.Random(8)
    rows = []
    for i in range(4000):
        insult = i % 4 == 0
        text = " ".join("".join(rng.choice("bcdfgklmnprstvz") + rng.choice("aeiou") for _ in range(4)) for _ in range(12))
        rows.append((i, "you idiot " + text if insult else text, int(rng.random() < (0.3 if insult else 0.02))))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, label int").select("doc_id", "text"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, label int")
    toxic = sum(r[2] for r in rows)
    assert 300 < toxic < 500
    texts = ["you idiot " + rows[1][1], rows[1][1]]
    whole, bounded = (toxicity.train(docs, labels, n).score(texts) for n in (4000, 250))
    assert abs(whole[0] - 0.3) < 0.06 and abs(bounded[0] - whole[0]) < 0.1 and abs(bounded[1] - whole[1]) < 0.03


def test_toxicity_odd(spark, odd):
    labels = spark.createDataFrame([(1, 1, 1), (3, 1, 0), (3, 1, 1), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        got = toxicity.report(odd, known).collect()
        assert len(got) == odd.count() and len({r.score for r in got if r.doc_id == 3}) == 1 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.drop_toxic(odd, labels.limit(0)).columns == odd.columns
    assert toxicity.report(odd.limit(0), labels).count() == 0


# -- 1 quality ---------------------------------------------------------------------------

def test_quality_held_out(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op1_quality_classifier"](spark, folder).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(folder + "/labels.parquet").collect()}
    share, n = _accuracy(rows, labels)
    assert n > 50 and share >= 0.95 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_risk_gradient_and_prior():
    rng = np.random.default_rng(1)
    p, u = rng.normal(1, 1, (400, 3)), np.vstack([rng.normal(1, 1, (300, 3)), rng.normal(-2, 1, (200, 3))])
    theta, d = rng.normal(size=3), 1e-6
    risk, grad = quality_pu.nonnegative_risk(theta, p, u, 0.3)
    steps = [(quality_pu.nonnegative_risk(theta + d * e, p, u, 0.3)[0] - risk) / d for e in np.eye(3)]
    negative = np.logaddexp(0, u @ theta).mean() - 0.3 * np.logaddexp(0, p @ theta).mean()
    assert negative > 0 and np.allclose(grad, steps, atol=1e-3)
    assert 0.5 < quality_pu.estimate_prior(p, u) < 0.75  # the truth is 0.6


def test_quality_odd(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, 0), (4, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        got = quality_pu.report(odd, known).collect()
        assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in quality_pu.report(odd, labels.limit(0)).collect()} == {0.5}
    assert quality_pu.report(odd.limit(0), labels).count() == 0


# -- 6 chat --------------------------------------------------------------------------------

def test_chat_round_trip(spark):
    rng, t = random.Random(1), chat_format.INSTRUCT
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "<<SYS>>", "\n", " ", "a", "<", "s>", "[", "]", "[ROLE]", "[/NAME]", "[/ROLE]", "é"]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))
    assert all(t.unescape(t.escape(x)) == x for x in (text() for _ in range(3000)))
    rows = [(c or None, k, rng.choice(["user", "assistant", "system", None, "tool", "t] [/NAME] x\\"]), rng.choice([None, text()]), "x") for c in range(60) for k in range(rng.randint(1, 5))]
    rows += [(200, 0, "user", "x\\", ""), (200, 0, "user", "x\\", ""), (201, None, "assistant", "</s>", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, loss string")
    got = {r.conv_id: r for r in chat_format.report(df).collect()}
    whole = {r.conv_id: r for r in chat_format.formatted(df).collect()}
    assert set(got) == {r[0] for r in rows} == set(whole)
    for c, g in got.items():
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", (r[3] or "").encode()))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        learned = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert (g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
        w = whole[c]
        assert len(w.text) == g.formatted_chars and "".join(t.unescape(w.text[s.start : s.end]) for s in w.loss_spans) == learned
    assert chat_format.report(df.limit(0)).count() == 0


def test_chat_turn_order(spark):
    roles = {1: "system user assistant", 2: "user assistant user", 3: "assistant user", 4: "user user", 5: "user system", 6: "tool"}
    df = spark.createDataFrame([(c, i, r, "t") for c, s in roles.items() for i, r in enumerate(s.split())], "conv_id long, turn long, role string, text string")
    assert {r.conv_id: r.valid for r in chat_format.report(df).collect()} == {1: True, 2: True, 3: False, 4: False, 5: False, 6: False}


# -- 8 HTML --------------------------------------------------------------------------------

def test_min_cut_is_minimal():
    rng = random.Random(2)
    for _ in range(150):
        n = rng.randint(1, 8)
        unary = [rng.choice([0, 1, -1, 0.5, -2, 3, -0.3]) for _ in range(n)]
        links = [(a, b, rng.choice([0.5, 1, 0.25, 2])) for a in range(n) for b in range(a) if rng.random() < 0.4]
        cost = lambda y: sum(abs(u) for u, k in zip(unary, y) if u and (u > 0) != k) + sum(w for a, b, w in links if y[a] != y[b])  # noqa: B023, E731
        assert abs(cost(html_extract.min_cut(unary, links)) - min(cost(y) for y in itertools.product([False, True], repeat=n))) < 1e-5


def test_no_markup_fails_and_no_article_is_lost():
    text = html_extract.main_text
    for bad in ("<p>a</p><![x>b", "<article>x</article><![foo bar]]>", "<!x[", "<![if !IE]>y<![endif]>", "<!-- open", "<!", "<![", "<a href='", "<![CDATA[ z", "<!DOCTYPE [", "</", "<?x", "&#;&#x;&bogus"):
        assert isinstance(text(bad), str) and text("<article><p>Kept here.</p></article>" + bad).startswith("Kept here.")
        assert "Kept here." in text("<article><p>One.</p>" + bad + "><p>Kept here.</p></article>") or bad in ("<!-- open", "<a href='")
    for around in ('<div id="content" class="site-content has-sidebar"><article>{}</article></div>', '<main class="layout-sidebar-right"><article>{}</article></main>', '<article class="post comments-open">{}</article>'):
        assert text(around.format("<p>Some text.</p>")) == "Some text."
    assert text('<article><div class="article-header"><h1>Head</h1></div><p class="legal">Legal text.</p></article>') == "Head\nLegal text."
    assert text('<article><p>Text.</p></article><div class="sidebar"><p>Side.</p></div><article class="comment"><p>Reader.</p></article>') == "Text."
    rng = random.Random(4)
    pieces = ["<", ">", "![", "]]>", "<!", "<!--", "-->", "<p>", "</p>", "<article>", "<x", "&", "&#", "'", '"', "=", "a", "[", "<?", "</"]
    for _ in range(3000):
        text("".join(rng.choice(pieces) for _ in range(rng.randint(1, 12))))


def test_cut_puts_wrong_costs_right():
    """Pages without a telling tag or class: short lines inside running text are kept, long ones inside a menu are not."""
    run = "<p>This is a long sentence of running text, number {}, with words and commas.</p>"
    article = "".join(run.format(i) for i in range(4)) + "<p>See also</p>" + "".join(run.format(i) for i in range(4, 8))
    menu = "".join(f'<li><a href="/{i}">Page {i}</a></li>' for i in range(5)) + '<li><a href="/x">' + run.format(9)[3:-4] + "</a></li>" + "".join(f'<li><a href="/{i}">Page {i}</a></li>' for i in range(6, 10))
    page = f"<div><ul>{menu}</ul></div><div>{article}</div>"
    own = html_extract.odds(html_extract.blocks_of(page), html_extract.DEFAULT)
    assert own[14] < 0  # the short line by itself is no content
    assert html_extract.main_text(page).split("\n") == [run.format(i)[3:-4] for i in range(4)] + ["See also"] + [run.format(i)[3:-4] for i in range(4, 8)]
    blocks, reached, turned = html_extract.settled_by_cut(page)
    assert blocks == 19 and reached >= 17 and turned >= 1


def test_inline_furniture_is_linear():
    html = "<article><p>" + "A <span class='share'>x</span> " * 40_000 + "</p></article>"
    assert html_extract.main_text(html) == " ".join("A" * 40_000)


def test_hints_are_trusted_as_far_as_the_text_agrees():
    assert html_extract.trust(0, 0) == 0 and html_extract.trust(100, 100) == html_extract.HINT and html_extract.trust(30, 100) == 0
    assert 0 < html_extract.trust(60, 100) < html_extract.HINT


def test_main_text():
    body = ('<html><head><title>T</title><style>p{}</style></head><body><div class="cookie-notice"><p>We use cookies, many of them, to serve you.</p></div><header><h1>Site</h1></header>'
            '<nav><a href="/">Home</a></nav><div id="content"><h2>Head</h2><p>A &amp; b&nbsp;c <i>d</i>e.<!-- no --></p><div class="ad">Buy</div><ul><li>one<li>two</ul><form>name <input></form>'
            '<script>var t="</p>";</script></div><aside>more</aside><section id="comments"><article class="comment"><p>nice</p></article></section><footer>&copy;</footer></body>')
    assert html_extract.main_text(body) == "Head\nA & b c de.\none\ntwo"
    assert html_extract.main_text("<article><header><h1>Title</h1></header><p>x &#8217;<br>y<p>z") == "Title\nx \u2019 y\nz"
    assert html_extract.main_text("") == "" and html_extract.main_text("<nav><p>menu") == ""
    assert html_extract.main_text("<article>" + "<div>" * 30_000 + "deep") == "deep"


def test_main_text_around_inline_furniture():
    for mark in ('class="share"', 'class="ad"', 'id="related"', 'class="reply"', "hidden"):
        assert html_extract.main_text(f"<article><p>A <span {mark}>x</span> B</p><p>C</article>") == "A B\nC"
        assert html_extract.main_text(f"<article><p><span {mark}>x</span> B <i>c</i> <b {mark}>y <i>z</i></b>D<br>e</p></article>") == "B c D e"
    # without a hint of its own the text around is judged as one block
    pieces = html_extract.blocks_of('<p>one <a class="ad" href="/">buy</a>two <span class="text">three</span></p><div><span class="text">A</span> B</div>')
    assert [(b[0], b[1], b[3]) for b in pieces] == [("one two three", 0, 0), ("buy", 3, -1), ("A", 0, 1), ("B", 0, 0)]
    assert [b[6] for b in pieces] == [0, 0, 1, 1]
    assert html_extract.main_text('<article><p>A</p></article><div><span class="text">B</span> is a longer sentence, and it goes on.</div>', html_extract.Costs((0.0,) * 9 + (2.0,), html_extract.HINT, html_extract.HINT)) == "A\nB is a longer sentence, and it goes on."


def test_pages_query(spark):
    """Against the articles as the pages mark them."""
    import html

    folder = "/root/testdata/sf0.001"
    got = {r.page_id: r for r in QUERIES["op8_html_extraction"](spark, folder).collect()}
    for r in spark.read.parquet(folder + "/pages.parquet").collect():
        inside = re.search("<article>(.*?)</article>", r.html, re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(x).split()) for x in re.split("</?(?:h1|p)>", re.sub("</?b>", "", inside))]
        assert got[r.page_id].text == "\n".join(p for p in parts if p) and got[r.page_id].n_chars == len(got[r.page_id].text)
    odd = spark.createDataFrame([(1, None, None, 1), (1, None, None, 1), (None, "u", "", 2)], "page_id long, url string, html string, text int")
    assert [r.text for r in html_extract.report(odd).collect()] == ["", "", ""] and html_extract.report(odd.limit(0)).count() == 0


# -- 7 Jaccard join ------------------------------------------------------------------------

def _shingles(t):
    w = [x for x in re.split("[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def _near_texts(rng):
    word = lambda: "w%d" % rng.randint(0, 4000)
    texts = []
    for _ in range(25):
        base = [word() for _ in range(rng.choice([3, 40, 150]))]
        for _ in range(rng.choice([1, 2, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            texts.append(rng.choice([" ", "  ", "\n"]).join(copy))
    return texts + [None, "", "", " ", "one", "ONE", "a\x00b", "a\x01b", texts[0], texts[0]]


@pytest.mark.parametrize("block,limit", [(1 << 20, 1024), (300, 4)])
def test_jaccard_join_brute_force(spark, monkeypatch, block, limit):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)  # groups of many blocks
    monkeypatch.setattr(jaccard_join, "LIMIT", limit)  # nodes that split down to the last level
    texts = _near_texts(random.Random(limit))
    sets = [_shingles(t) for t in texts]
    n = len(texts)
    near = [[i != j and ((texts[i] or "") == (texts[j] or "") or bool(sets[i] | sets[j]) and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])) for j in range(n)] for i in range(n)]
    root = list(range(n))
    for _ in range(n):
        root = [min([root[i]] + [root[j] for j in range(n) if near[i][j]]) for i in range(n)]
    got = {r.doc_id: r for r in jaccard_join.report(docs_of(spark, texts)).collect()}
    assert [(got[i].class_id, got[i].n_links) for i in range(n)] == [(root[i], sum(near[i])) for i in range(n)]
    kept = jaccard_join.drop_near(docs_of(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root))


def test_jaccard_join_odd(spark, odd):
    got = jaccard_join.report(odd).collect()
    assert len(got) == odd.count() and {r.class_id for r in got if r.doc_id in (3, 6)} == {3}
    kept = jaccard_join.drop_near(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5]
    assert jaccard_join.report(odd.limit(0)).count() == 0 and jaccard_join.drop_near(odd.limit(0)).count() == 0


def test_recall_is_what_the_runs_promise():
    gone = 1 - jaccard_join.survival(jaccard_join.DEPTH)
    assert gone ** jaccard_join.runs_for() <= 1 - jaccard_join.RECALL < gone ** (jaccard_join.runs_for() - 1)


@pytest.mark.parametrize("depth", [7, 10])
def test_recall_of_planted_pairs(spark, monkeypatch, depth):
    """Pairs at the threshold whose nodes all count as large: they must be found at the last level."""
    monkeypatch.setattr(jaccard_join, "LIMIT", 1)
    monkeypatch.setattr(jaccard_join, "DEPTH", depth)
    rng, n = np.random.default_rng(depth), 4000
    left, other = (rng.integers(0, 1 << 16, (n, jaccard_join.SIZE), dtype=np.uint16) for _ in range(2))
    right = np.where(rng.random(left.shape) < jaccard_join.THRESHOLD, left, other)
    key = lambda i, side: hashlib.md5(f"{i} {side}".encode()).digest()
    rows = [(bytearray(key(i, side)), bytearray(sig[i].tobytes())) for i in range(n) for side, sig in ((0, left), (1, right))]
    edges = jaccard_join.candidate_edges(spark.createDataFrame(rows, "key binary, sig binary")).distinct().collect()
    found = {frozenset((bytes(e.u), bytes(e.v))) for e in edges}
    lost = sum(frozenset((key(i, 0), key(i, 1))) not in found for i in range(n))
    assert lost <= 10  # 4 are promised, with a standard deviation of 2


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randint(50, 120), rng.randint(50, 120)) for _ in range(60)] + [(200, 200)]
    root = {}
    for a, b in edges:
        if a != b:
            ra, rb = {root.get(a, a), root.get(b, b)}.pop(), root.get(b, b)
            merged = {k for k, v in root.items() if v in (root.get(a, a), rb)} | {a, b, ra, rb}
            for k in merged:
                root[k] = min(merged | {root.get(a, a)})
    got = {r.key: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    seen = {x for a, b in edges if a != b for x in (a, b)}
    assert set(got) == seen and all(got[a] == got[b] for a, b in edges if a != b)
    assert all(min(k for k in seen if got[k] == r) == r for r in set(got.values())) and got[40] == 0
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_url_weights_keep_the_ratio_of_all_rows(spark):
    """With both verdicts capped the fit stays near that of all rows; unweighted it would not."""
    rng = random.Random(6)
    rows = [(f"{'x' if rng.random() < (0.3 if i % 5 else 0.7) else 'y'}{rng.randint(0, 10**6)}.net", "/a", "allow" if i % 5 else "block") for i in range(3000)]
    labelled = spark.createDataFrame(rows, "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, f"http://{c}{i}.net/a") for i, c in enumerate("xyz" * 20)], "page_id long, url string")

    def p(limit):
        url_filter.train.__defaults__, kept = (limit,), url_filter.train.__defaults__
        try:
            return {r.page_id: r.p_block for r in url_filter.judge(pages, labelled).collect()}
        finally:
            url_filter.train.__defaults__ = kept

    whole, capped = p(5000), p(300)
    assert abs(np.mean([capped[i] - whole[i] for i in whole])) < 0.05
    assert np.mean(list(whole.values())) < 0.35  # a fifth of the rows is blocked


def test_marks_count_whole_and_prior_uses_all_rows(spark):
    text = "a b c " + "=" * 5000
    assert quality_pu.features(text)[5] > 0.9
    rng = np.random.default_rng(3)
    p, u = rng.normal(1, 1, (400, 3)), np.vstack([rng.normal(1, 1, (500, 3)), rng.normal(-2, 1, (500, 3))])
    prior = quality_pu.Prior(p, u)
    assert ((prior.place(u)[:, None] > np.arange(71)).sum(axis=0) == [(u @ prior.theta >= c).sum() for c in prior.cuts]).all()
    # the sample holds no junk at all, the table is mostly junk: the prior follows the table
    good, junk = [f"Word {i} is in a plain sentence, and so on. Another follows it." for i in range(60)], ["=== ### " * 9 + str(i) for i in range(240)]
    docs = docs_of(spark, good + junk)
    x = lambda t: np.array([quality_pu.features(s) for s in t])
    none = docs.select("doc_id").where("doc_id < 30")
    assert quality_pu._prior_of_all(docs, none, x(good[:30]), x(good[30:] + junk[:30])) < 0.35 < quality_pu.estimate_prior(*[quality_pu.scaling(x(good[:30]), x(good[30:] + junk[:30]))[2](z) for z in (x(good[:30]), x(good[30:] + junk[:30]))])


def test_hypergeometric_by_inversion():
    """The same law as the library's, also where few are expected; exact bounds and moments far beyond its size."""
    rng = np.random.default_rng(5)
    for good, bad, n in ((7, 12, 9), (3, 4000, 50), (900, 100, 300), (5, 5, 10), (1, 1, 1)):
        own = np.bincount([sharding._by_inversion(rng, good, bad, n) for _ in range(20_000)], minlength=n + 1) / 20_000
        want = np.bincount(rng.hypergeometric(good, bad, n, 200_000), minlength=n + 1) / 200_000
        assert np.abs(np.cumsum(own) - np.cumsum(want)).max() < 0.02
    good, bad, n = 6 * 10**9, 90 * 10**9, 10**7
    got = np.array([sharding._hypergeometric(rng, good, bad, n) for _ in range(200)])
    mean, sd = n * good / (good + bad), (n * good / (good + bad) * bad / (good + bad)) ** 0.5
    assert abs(got.mean() - mean) < 5 * sd / 200**0.5 and 0.8 < got.std() / sd < 1.2
    few = np.array([sharding._hypergeometric(rng, 4 * 10**9, 60 * 10**9, 8) for _ in range(3000)])
    assert few.max() <= 8 and abs((few == 0).mean() - (15 / 16) ** 8) < 0.04  # a rounded normal would not give this
    assert sharding._by_inversion(rng, 10**10, 5, 10**10 + 5) == 10**10


def test_loss_is_read_through_the_mask(spark):
    """A mask of the right length on the wrong segment, or moved within a text, is refused."""
    rows = [(1, 0, "user", "abcd"), (1, 1, "assistant", "wxyz")]
    made = chat_format.segments(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    good = chat_format.read_back(made).first()
    assert good.loss_sha256 == hashlib.sha256(b"wxyz").hexdigest() and good.loss_chars == 4
    moved = made.withColumn("loss", (F.col("kind") == "text") & (F.col("turn_no") == 0))
    with pytest.raises(Exception, match="can't be read back"):
        chat_format.read_back(moved).collect()
    with pytest.raises(Exception, match="can't be read back"):
        chat_format.read_back(made.withColumn("loss", F.lit(False))).collect()

"""The training-data operators on small fixtures: brute force, round trips, and the edge cases that their docstrings define."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidewatch.llm import bytehash, decontaminate, exact_dedup, html_text, mixing, near_dedup, queries, quotes, repeats, toxicity, url_filter, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, run int, component string"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", None if n % 5 == 4 else f"s{n % 2}", 0, 1, "x") for n, (i, t) in enumerate(texts)], DOCS)


def word_texts(n=40, seed=1):
    r = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)]
    out = []
    for i in range(n):
        if i % 4 == 3:  # a near copy of an earlier text
            w = out[int(r.integers(len(out)))][1].split(" ")
            for _ in range(int(r.integers(0, 4))):
                w[int(r.integers(len(w)))] = "edit"
            out.append((i, " ".join(w)))
        else:
            out.append((i, " ".join(r.choice(words, int(r.integers(30, 120))))))
    return out


EDGES = [(100, None), (101, ""), (102, " \t\n"), (103, "one"), (103, "one"), (104, "one two three four"), (None, "one"), (105, "w " * 3000), (106, "w " * 3000), (107, "É é ß 漢字"), (108, "É é ß 漢字")]


def test_near_duplicates_equal_brute_force(spark):
    texts = word_texts() + [e for e in EDGES if e[0] is not None]
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j : j + 4]) for j in range(len(w) - 3)} or ({tuple(w)} if w else set())
    up = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    up[i] = up[j] = min(up[i], up[j])
    for leaf in (16,):
        got = near_dedup.near_duplicates(docs(spark, texts + [(None, "one")]), k=4, leaf=leaf).collect()
        assert len(got) == len(texts) + 1
        for r in got:
            if r.doc_id is None:
                assert r.component_id is None and r.kept
            else:
                assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), up[r.doc_id], up[r.doc_id] == r.doc_id)
    assert near_dedup.near_duplicates(docs(spark, [])).count() == 0


def test_near_duplicates_in_a_dense_group(spark):
    """Texts around one base, most of them alike but below the threshold: pairs that many nodes hold lose no link."""
    r = np.random.default_rng(5)
    base = [f"w{x}" for x in r.integers(0, 3000, 150)]
    texts = []
    for i in range(150):
        w = list(base)
        for p in r.integers(0, 150, int(r.integers(2, 9))):
            w[p] = f"e{r.integers(0, 40)}"
        texts.append((i, " ".join(w)))
    sets = [{tuple(w[j : j + 4]) for j in range(len(w) - 3)} for w in (t.split(" ") for _, t in texts)]
    up = list(range(len(sets)))
    for _ in sets:
        for i in range(len(sets)):
            for j in range(i):
                if up[i] != up[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    up[i] = up[j] = min(up[i], up[j])
    assert 5 < len(set(up)) < 145
    got = near_dedup.near_duplicates(docs(spark, texts), k=4, leaf=80).collect()
    assert {x.doc_id: x.component_id for x in got} == dict(enumerate(up))


def covered(texts, length):
    seen = collections.Counter()
    raw = [(t or "").encode() for _, t in texts]
    for b in raw:
        seen.update(b[i : i + length] for i in range(len(b) - length + 1))
    for (i, _), b in zip(texts, raw, strict=True):
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = True
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        yield i, len(b), int(gone.sum()), int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0, hashlib.sha256(kept).hexdigest()


def test_repeats_equal_brute_force(spark):
    base = word_texts(12, 3)
    texts = base + [(50, base[0][1][50:400] + "x" * 900 + base[1][1][10:300]), (51, base[0][1]), (52, "ab" * 300), *EDGES]
    want = sorted(covered(texts, 200), key=str)
    for crowd in (4096, 1):
        got = sorted((tuple(r) for r in repeats.cut_repeats(docs(spark, texts), crowd=crowd).collect()), key=str)
        assert got == want
    assert repeats.cut_repeats(docs(spark, [])).count() == 0


def test_suffix_order_is_sorted():
    r = np.random.default_rng(2)
    data = np.concatenate([r.integers(97, 99, 400), r.integers(97, 99, 400)] * 2).astype(np.uint8)
    starts = np.arange(len(data) - 200)
    with np.errstate(over="ignore"):
        order, extension = repeats.suffix_order(data, bytehash.prefix(data), starts, 200)
    cut = [data[s : s + 200].tobytes() for s in order]
    assert cut == sorted(cut)
    assert all((e == 200) == (a == b) for a, b, e in zip(cut, cut[1:], extension[1:], strict=False))


def test_exact_duplicates(spark):
    got = exact_dedup.exact_duplicates(docs(spark, [(5, "a  b"), (3, "a\tb"), (9, "A b"), (None, "a b"), (7, None), (8, ""), (None, "z")])).collect()
    by = {(r.doc_id, r.text_sha256): (r.keep_id, r.group_size, r.kept) for r in got}
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert by[5, h("a b")] == (3, 3, False) and by[3, h("a b")] == (3, 3, True) and by[None, h("a b")] == (3, 3, False)
    assert by[7, h("")] == (7, 2, True) and by[8, h("")] == (7, 2, False) and by[None, h("z")] == (None, 1, True)
    assert exact_dedup.exact_duplicates(docs(spark, [])).count() == 0


def test_contaminated(spark):
    item = " ".join(f"q{i}" for i in range(40))
    short = [(1, "hello world"), (2, item), (3, None), (3, ""), (None, "a b c d e f")]
    bench = spark.createDataFrame(short, "item_id long, text string")
    near = item.replace("q20 ", "x ")
    texts = [(1, "pad " * 5000 + item.upper()), (2, "hello world"), (3, "hello world again"), (4, "q1 q2 q3 q4 q5 q6"), (5, None), (None, near), (6, near.replace("q5 ", "y ").replace("q33 ", "z "))]
    got = {r.doc_id: r.contaminated for r in decontaminate.contaminated(docs(spark, texts), bench).collect()}
    assert got == {1: True, 2: True, 3: False, 4: False, 5: False, None: True, 6: False}
    assert decontaminate.contaminated(docs(spark, []), bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.contaminated(docs(spark, texts), bench.limit(0)).collect())


def test_mixing_rates(spark):
    texts = [(i, f"t{i}") for i in range(2000)] + [(None, None), (7, "t7")]
    out = mixing.mixed(docs(spark, texts), {"s0": 3.0, "s1": 1.0}, target_rows=4000).collect()
    n = collections.Counter(r.source for r in out)
    assert set(n) == {"s0", "s1"} and abs(n["s0"] - 3000) < 250 and abs(n["s1"] - 1000) < 150
    assert [r.shuffle_key for r in out] == sorted(r.shuffle_key for r in out)
    many = mixing.mixed(docs(spark, [(1, "a")]), None, target_rows=900).count()
    assert abs(many - 900) < 200
    assert mixing.mixed(docs(spark, [])).count() == 0


def test_toxicity_learns_and_holds(spark):
    r = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)]
    texts, labels = [], []
    for i in range(600):
        w = list(r.choice(words, 40))
        if i % 6 == 0:
            w[int(r.integers(40))] = "slurry"
            w[int(r.integers(40))] = "slurwort"
        texts.append((i, " ".join(w)))
        labels.append((i, 1, int(i % 6 == 0)))
    d = docs(spark, [*texts, (None, None), (9001, ""), (9002, "slurry " * 4000)])
    known = spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in toxicity.toxicity(d, toxicity.fit(d, known), with_spans=True).collect()}
    right = sum(got[i].predicted == int(i % 6 == 0) for i in range(600))
    assert right >= 570 and got[9001].predicted == 0 and got[None].predicted == 0 and got[9002].predicted == 1
    assert got[0].passages and 0 <= got[0].score <= 1
    none = toxicity.toxicity(d, toxicity.fit(d, known.limit(0)))
    assert not any(x.predicted for x in none.collect())
    assert toxicity.toxicity(docs(spark, []), toxicity.fit(d, known)).count() == 0


def test_toxicity_counts_all_but_copies(spark):
    """Texts that share only the passage with the least trigram all count; an equal and a nearly equal one don't, in each label."""
    r = np.random.default_rng(3)
    passage = " ".join(f"p{i}" for i in range(100))
    own = [" ".join(f"w{x}" for x in r.integers(0, 10**6, 40)) for _ in range(60)]
    near = own[0].split(" ")
    near[30] = "edit"
    texts = [f"{passage} {x}" for x in own] + [f"{passage}  {own[1].upper()}", f"{passage} {' '.join(near)}", "", None, f"{passage} {own[2]}"]
    known = spark.createDataFrame([(i, int(i == len(texts) - 1)) for i in range(len(texts))], "doc_id long, toxic int")
    rows = toxicity.training_rows(docs(spark, list(enumerate(texts))), known)
    assert rows.where("first is null").count() < 40
    got = rows.mapInArrow(toxicity._counts, "feature long, clean long, toxic long").groupBy("feature").agg({"clean": "sum", "toxic": "sum"}).where(f"feature = {toxicity.FEATURES}").first()
    assert (got["sum(clean)"], got["sum(toxic)"]) == (61, 1)


def test_extreme_values_equal_closed_form():
    """Scores of 1 with share p and -1 with share q: lambda is log(q / p), K is (q - p) ** 2 / q."""
    m = toxicity.Model(np.zeros(toxicity.FEATURES + 1, int), np.zeros(toxicity.FEATURES + 1, int), 10, 1.5, 2.5)
    m.fit_rate(np.array([-100, 100]), np.array([7000, 3000]))
    assert abs(m.rate - np.log(7 / 3)) < 1e-6 and abs(m.k - 0.16 / 0.7) < 1e-4


def test_toxicity_rate_is_of_all_clean_tokens(spark):
    r = np.random.default_rng(6)
    texts, labels = [], []
    for i in range(400):
        w = [f"w{x}" for x in r.integers(0, 200, 60)]
        if i % 3 == 0 or i % 20 == 1:
            w[5] = "slurry"
        texts.append((i, " ".join([*w, *["common"] * (i % 7)])))
        labels.append((i, int(i % 3 == 0)))
    d, known = docs(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int")
    m = toxicity.fit(d, known)
    train = [t for (i, t), (_, y) in zip(texts, labels, strict=True) if y == 0 and zlib.crc32(str(i).encode()) % 4 != 2]
    score = []
    for t in train:
        off, data = toxicity.text_bytes(pa.array([t]))
        score += m.token_scores(toxicity._features(data, off)[2]).tolist()
    assert max(score) > 0 and abs(np.exp(m.rate * np.round(score, 2)).mean() - 1) < 1e-3


def test_segments_equal_brute_force():
    r = np.random.default_rng(4)
    for _ in range(200):
        s = np.round(r.normal(-0.3, 1, int(r.integers(1, 30))), 2)

        def split(lo, hi):  # the definition: the best segment, then the same on both sides
            best = max(((s[a:b].sum(), a - b, a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0, 0, 0, 0), key=lambda x: (round(x[0], 6), x[1], -x[2]))
            if best[0] <= 1e-9:
                return []
            _, _, a, b = best
            return [*split(lo, a), (a, b), *split(b, hi)]

        assert [round(sum(s[a:b]), 6) for a, b in split(0, len(s))] == [round(x[2], 6) for x in toxicity.segments(s)]


PAGES = "page_id long, url string, html string, host string, rule string, salt int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", "r", 1) for r in rows], PAGES)


def test_html():
    page = """<html><head><title>t</title></head><body class="has-sidebar"><nav><a href=/>Home</a></nav><div class="cookie-notice">We use cookies, really</div>
      <main><article><h1>A &amp; B</h1><p>First,
      long   line<p>Second<br>line<script>var a="</p>"</script><ul><li>x</ul><aside>no</aside><form><input>no</form><section id=comments><p>Nice, post, yes, good</p></section></article></main>
      <footer>&copy; me</footer>"""
    assert html_text.main_text(page) == "A & B\n\nFirst, long line\n\nSecond line\n\nx"
    div = "<body><div id=menu><a href=a>one, two</a></div><div><h2>T</h2><div class=body><p>" + "word, word " * 30 + "</p><p>more</p></div></div><div class=ads>buy, now</div>"
    assert html_text.main_text(div).startswith("T\n\nword, word") and html_text.main_text(div).endswith("more")
    for odd in (None, "", "<", "<p", "plain", "<p>a<b", "<![CDATA[x", "</p></div>", "<!-- x"):
        assert isinstance(html_text.main_text(odd), str)
    assert html_text.main_text("plain text") == "plain text"


def test_html_rows(spark):
    got = html_text.extract_text(pages(spark, [(1, None, None), (2, "u", "<p>é 漢"), (2, "u", "<p>é 漢"), (None, "v", "")])).collect()
    assert sorted((r.n_chars, r.text) for r in got) == [(0, ""), (0, ""), (3, "é 漢"), (3, "é 漢")]
    assert html_text.extract_text(pages(spark, [])).count() == 0


def test_warc_round_trip(spark):
    odd = "a\r\n\r\nWARC/1.1\r\nb\n\n é" + "x" * 5000
    rows = [(3, "http://a b/é", odd), (1, None, odd), (2, "u", None), (5, "u", ""), (None, "u", odd), (7, "u", "\n")]
    got = {r.page_id: r for r in warc.archived(pages(spark, rows)).collect()}
    assert len(got) == 6
    assert (got[1].record_type, got[3].record_type, got[3].refers_to) == ("response", "revisit", 1)
    assert (got[2].record_type, got[5].refers_to, got[2].payload_bytes) == ("response", 2, 0)
    assert got[None].record_type == "response" and got[3].payload_bytes == len(odd.encode()) and got[3].payload_digest == warc.digest32(odd.encode())
    assert warc.archived(pages(spark, [(4, "u", "x"), (9, "u", "x")]), revisit_min=10).where("record_type = 'response'").count() == 2
    assert warc.archived(pages(spark, [])).count() == 0


def test_arc_versions():
    for version in (1, 2):
        data = warc.arc_record(version, "http://x y", b"one\ntwo") + warc.arc_record(version, None, b"")
        head, payload, at = warc.parse_arc(data)
        assert payload == b"one\ntwo" and head["url"] == "http://x%20y"
        assert warc.parse_arc(data, at)[1:] == (b"", len(data))
        rows = [("http://x y", b"one\ntwo\n"), (None, b""), ("u", b"filedesc://x 1 2 3 4\n")]
        got = list(warc.arc_records(warc.arc_file(version, rows)))
        assert [p for _, p in got] == [p for _, p in rows] and [h["url"] for h, _ in got] == ["http://x%20y", "-", "u"] and tuple(got[0][0]) == warc.ARC_FIELDS[version]
        assert list(warc.arc_records(warc.arc_file(version, []))) == []
    for bad in (b"http://x 0 0 text/html 99\nshort\n", b"http://x 0 0 text/html 1\na\n", warc.arc_file(1, []) + warc.arc_record(2, "u", b"x"), warc.arc_file(1, []).replace(b"1 0 tide", b"3 0 tide")):
        with pytest.raises(ValueError):
            list(warc.arc_records(bad))


def test_url_rules_and_propagation(spark):
    a = '<a href="{}">x</a>'.format
    rows = [(1, "http://A.com/en/1", a("http://evil.com/en/2")), (2, "http://evil.com/en/2?x", None), (3, "http://evil.com/de/2", ""), (4, "http://example.com/en/77", ""), (5, "x.example.net/de/8", ""), (6, None, None),
            (7, "https://b.example.net/de/81#x", ""), (8, "https://friend.org/x", a("//evil.com/de/2")), (9, "https://good.net/de/", a("https://fine.org/")), (10, "https://fine.org/y", ""), (11, "https://s.net/de", "")]
    got = {r.page_id: r for r in url_filter.url_verdicts(pages(spark, rows)).collect()}
    assert {i: (r.rule, r.verdict) for i, r in got.items() if r.rule} == {1: ("com/en/", "block"), 2: ("com/en/", "block"), 4: ("example.com/en/7", "allow"), 7: ("example.net/de/8", "block"), 9: ("net/de/", "allow")}
    assert (got[6].host, got[6].path, got[6].verdict, got[5].host) == ("", "", "allow", "")
    assert got[1].host == "a.com" and got[3].verdict == "block" and got[8].verdict == "block" and got[10].verdict == "allow" and got[11].verdict == "allow"
    # brute force: trust forwards, distrust backwards, to the fixed point
    t, b = fixed_point([("a.com", "evil.com"), ("friend.org", "evil.com"), ("good.net", "fine.org")], {"good.net": 1.0}, {"a.com": 1.0, "evil.com": 0.5})
    for i, h in ((1, "a.com"), (3, "evil.com"), (8, "friend.org"), (9, "good.net"), (10, "fine.org")):
        assert abs(got[i].trust - t.get(h, 0)) < 1e-3 and abs(got[i].distrust - b.get(h, 0)) < 1e-3
    assert url_filter.url_verdicts(pages(spark, [])).count() == 0


def fixed_point(edges, t0, b0):
    t, b, hosts = {}, {}, {h for e in edges for h in e}
    for _ in range(300):
        t, b = ({h: 0.15 * t0.get(h, 0) + 0.85 * sum(t.get(x, 0) / sum(1 for z, _ in edges if z == x) for x, y in edges if y == h) for h in hosts},
                {h: 0.15 * b0.get(h, 0) + 0.85 * sum(b.get(y, 0) / sum(1 for _, z in edges if z == y) for x, y in edges if x == h) for h in hosts})
    return t, b


def test_url_scores_settle(spark):
    """A chain of 14 hosts into a blocked one, and a ring: scores at the fixed point."""
    rows = [(i, f"http://h{i}.org/x", f'<a href="http://h{i + 1}.org/">x</a>') for i in range(14)] + [(14, "http://h14.org/es/1", None)]
    rows += [(20 + i, f"http://r{i}.net/de/", f'<a href="http://r{(i + 1) % 3}.net/x">x</a>') for i in range(3)]
    edges = [(f"h{i}.org", f"h{i + 1}.org") for i in range(14)] + [(f"r{i}.net", f"r{(i + 1) % 3}.net") for i in range(3)]
    t, b = fixed_point(edges, {f"r{i}.net": 1.0 for i in range(3)}, {"h14.org": 1.0})
    got = url_filter.url_verdicts(pages(spark, rows), tolerance=1e-5).collect()
    assert all(abs(r.trust - t[r.host]) < 1e-4 and abs(r.distrust - b[r.host]) < 1e-4 for r in got)
    assert {r.host for r in got if r.verdict == "block"} == {h for h in b if b[h] >= 0.03}
    assert 8 < sum(r.verdict == "block" for r in got) < 14


def test_url_one_bad_page_blocks_no_host(spark):
    rows = [(i, f"http://big.org/de/{i}", "") for i in range(20)] + [(20, "http://big.org/es/1", ""), (20, "http://big.org/es/1", "")]
    got = url_filter.url_verdicts(pages(spark, rows)).collect()
    assert sorted((r.page_id, r.verdict) for r in got) == [(i, "allow") for i in range(20)] + [(20, "block")] * 2


def test_quotes(spark):
    rows = [(1, 0, "user", "Hello  there\nsecond"), (1, 1, "a", "> hello there\nHi"), (1, 2, "user", ">> Hello there\n> hi\nok"), (2, 0, "u", "> second\nnew"), (2, 1, None, None), (None, 1, "u", "> hi"), (3, 0, "u", "> never written"), (1, 0, "user", "Hello  there\nsecond")]
    d = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, level string")
    got = {(r.conv_id, r.turn): r for r in quotes.link_quotes(d).collect()}
    assert len(got) == 7 and quotes.link_quotes(d).count() == 8
    assert (got[1, 1].text, got[1, 1].reply_conv, got[1, 1].reply_turn) == ("Hi", 1, 0)
    assert (got[1, 2].text, got[1, 2].reply_turn, got[1, 2].depth, got[1, 2].n_quotes) == ("ok", 1, 2, 2)
    assert (got[2, 0].reply_conv, got[2, 0].reply_turn) == (1, 0) and got[3, 0].reply_conv is None and got[None, 1].reply_conv is None
    assert quotes.link_quotes(d.limit(0)).count() == 0


def test_quotes_order_by_replies(spark):
    """Brute force over random answers, within and across conversations; a chain of 20 among them."""
    r = np.random.default_rng(8)
    keys = [(c, t) for c in range(6) for t in range(8)]
    up = {k: keys[int(r.integers(n))] for n, k in enumerate(keys) if n and r.random() < 0.7}
    up |= {(9, t): (9, t - 1) for t in range(1, 21)}
    keys += [(9, t) for t in range(21)]
    rows = [(c, t, "u", (f"> line {up[c, t]}\n" if (c, t) in up else "") + f"line {(c, t)}") for c, t in keys]
    # an answer within the conversation has to be to an earlier turn, across to a lower conversation: all of `up` are
    got = quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()

    def root(k, n=0):
        return root(up[k], n + 1) if k in up else (*k, n)

    assert {(x.conv_id, x.turn): (x.thread_conv, x.thread_turn, x.reply_depth) for x in got} == {k: root(k) for k in keys}
    assert [(x.conv_id, x.turn) for x in got] == sorted(keys, key=lambda k: (*root(k), *k)) != sorted(keys)
    at = {(x.conv_id, x.turn): n for n, x in enumerate(got)}
    assert all(at[k] > at[p] for k, p in up.items())


def test_quoted_passages():
    text = "On Monday, Ann wrote:\n> a  B\n>\n> c\n>> deep\n> d\n\nmine\n\nBob wrote:\n\n> > x\n> y wrote:\n> > z"
    own, passages, mine, n, deepest = quotes.quoted(text)
    assert own == "mine" and mine == ["mine"] and (n, deepest) == (6, 2)
    assert sorted(passages) == [(1, ["a b"]), (1, ["a b", "c", "d"]), (1, ["c", "d"]), (2, ["deep"]), (2, ["x"]), (2, ["z"])]
    assert quotes.quoted(None) == ("", [], [], 0, 0) and quotes.quoted("Ann wrote:\nx")[0] == "Ann wrote:\nx"
    assert quotes.quoted("> " * 5000)[1] == []


def test_quotes_equal_brute_force(spark, monkeypatch):
    """Passages of few different lines, so that many messages hold each: the target by the definition, for every message."""
    monkeypatch.setattr(quotes, "STRETCH", 3)
    r = np.random.default_rng(9)
    lines = ["ok", "thanks", "yes, I agree", "so be it", "no"]
    pick = lambda n: [lines[int(x)] for x in r.integers(0, 5, n)]
    rows = []
    for c in range(7):
        for t in range(12):
            quote = [(int(r.integers(1, 3)), pick(int(r.integers(1, 4)))) for _ in range(int(r.integers(0, 3)))] if r.random() < 0.6 else []
            text = "".join("".join(f"{'>' * k} {x}\n" for x in q) + f"own {r.integers(10**9)}\n" for k, q in quote) + "\n".join(pick(int(r.integers(1, 5))))
            rows.append((c, t, "u", text))
    known = {(c, t): quotes.quoted(x) for c, t, _, x in rows}

    def holds(k, p):
        mine = known[k][2]
        return any(mine[i : i + len(p)] == p for i in range(len(mine)))

    want = {}
    for c, t in known:
        votes = collections.Counter()
        for level, p in {(k, tuple(x)) for k, x in known[c, t][1]}:
            at = [k for k in known if holds(k, list(p))]
            own = [k for k in at if k[0] == c and k[1] < t]
            lower, higher = [k for k in at if k[0] < c], [k for k in at if k[0] > c and not known[k][3]]
            if own or lower or higher:
                votes[level, max(own) if own else min(lower) if lower else min(higher)] += len(p)
        want[c, t] = min(((k, -n, to[0] != c, -to[1], to) for (k, to), n in votes.items()), default=(None,))[-1]
    assert sum(x is not None for x in want.values()) > 25 and any(x and x[0] > k[0] for k, x in want.items()) and any(x and x[0] < k[0] for k, x in want.items())
    got = quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {(x.conv_id, x.turn): (x.reply_conv, x.reply_turn) for x in got} == {k: x or (None, None) for k, x in want.items()}


def test_mixing_query_returns_the_texts(spark, tmp_path):
    d = docs(spark, [(i, f"text {i}") for i in range(300)])
    d.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op6_mixing(spark, str(tmp_path))
    assert [c for c in got.columns if c in d.columns] == d.columns
    rows = got.collect()
    assert rows and all(r.text == f"text {r.doc_id}" for r in rows) and [r.shuffle_key for r in rows] == sorted(r.shuffle_key for r in rows)


def test_mixing_with_many_sources(spark, monkeypatch):
    """The shuffled join draws what the broadcast one draws; clashing columns are dropped."""
    d = docs(spark, [(i, f"t{i}") for i in range(400)] + [(None, None)])
    clash = d.selectExpr("*", "1 AS copy", "2 AS parts", "3 AS who", "4 AS salt", "5 AS shuffle_key")
    want = [tuple(r) for r in mixing.mixed(d).collect()]
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert [tuple(r) for r in mixing.mixed(clash).collect()] == want

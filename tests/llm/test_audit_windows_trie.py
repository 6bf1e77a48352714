"""Filter audit, repeated token windows and the trie of conversations against brute force, and the edge cases of their docstrings."""

import collections
import glob
import hashlib
import itertools
import os
import re
import zlib

import duckdb
import numpy as np
import pytest

from tidewatch.llm import filter_audit, prefix_trie, queries, windows

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, kept_text string, part string, mask int, bucket int, batch long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y", 1, 2, 3) for i, t, s in rows], DOCS)


def texts(n=60, seed=3):
    r = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(300)] + ["A#", "É", "\x85x"]
    shared = [" ".join(r.choice(words, int(r.integers(20, 60)))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = [" ".join(r.choice(words, int(r.integers(0, 50)))) for _ in range(3)]
        for _ in range(int(r.integers(0, 3))):
            parts.insert(int(r.integers(len(parts) + 1)), shared[int(r.integers(6))])
        out.append("\n\t".join(parts))
    return out


EDGES = [None, "", " \t\n", "one", "w " * 3000, "w " * 3000, "a b c d e " * 4, "\x0b".join("abcdefghijklmnopqrstu"), "ABC DEF", "x | y"]


def brute_windows(rows, length=20):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    seen, out = set(), []
    for k in order:
        w = WORD.findall(rows[k][1] or "")
        gone = set()
        for i in range(len(w) - length + 1):
            x = tuple(w[i : i + length])
            if x in seen:
                gone |= set(range(i, i + length))
            seen.add(x)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((rows[k][0], len(w), len(gone), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("batch", [400, 1 << 20])
def test_windows_equal_brute_force(spark, batch, monkeypatch):
    rows = [(i * 7 % 101, t, "s") for i, t in enumerate(texts() + EDGES)] + [(None, "a b c d e " * 4, "s")]
    monkeypatch.setattr(windows, "PART", 128)  # words and windows are hashed in many parts
    got = windows.repeated_windows(docs(spark, rows), batch_bytes=batch).collect()
    assert sorted(((r.doc_id, r.n_words, sum(x.past - x.first for x in r.removed), r.kept_text) for r in got), key=str) == brute_windows(rows)
    for r in got:  # maximal intervals, in order
        assert all(a.past < b.first for a, b in zip(r.removed, r.removed[1:], strict=False)) and all(x.first < x.past for x in r.removed)
    assert windows.repeated_windows(docs(spark, [])).count() == 0


def test_windows_of_rows_that_share_an_id(spark):
    text = " ".join(f"v{i}" for i in range(25))
    got = windows.repeated_windows(docs(spark, [(1, text, "s"), (1, text, "s"), (1, None, "s")]), batch_bytes=50).collect()
    assert sorted(len(r.kept_text.split()) for r in got) == [0, 0, 25]


def test_windows_whose_first_hash_agrees_are_told_apart():
    low, high = np.array([5, 5, 5, 7, 5], np.uint64), np.array([1, 2, 1, 1, 2], np.uint16)
    order, new = windows._by_value(low, high)
    assert order.tolist() == [0, 2, 1, 4, 3] and new.tolist() == [True, False, True, False, True]


def test_very_long_text(spark):
    text = " ".join(f"w{i % 9973}" for i in range(400_000))
    (r,) = windows.repeated_windows(docs(spark, [(1, text, "s")])).collect()
    assert r.n_words == 400_000 and len(r.kept_text.split()) == 9973 and [tuple(x) for x in r.removed] == [(9973, 400_000)]


def brute_audit(rows, labels):
    first = {}
    rank = lambda i: (i is None, i or 0)
    for i, t, _ in rows:
        first[t or ""] = min(first.get(t or "", rank(i)), rank(i))
    label = collections.defaultdict(lambda: [0, 0])
    for i, q, x in labels:
        if i is not None:
            label[i] = [max(label[i][0], q == 1), max(label[i][1], x == 1)]
    items = collections.defaultdict(list)
    for i, t, s in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = "".join(
            c for c, x in zip("ABCDE", (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search(r"[#$%&*|]", t)), rank(i) > first[t]), strict=True) if x
        )
        items[s or ""].append((fails, *(label[i] if i is not None else (0, 0))))
    out = {}
    for part, own in items.items():
        shapley = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                failing = sum(f in x[0] for x in own)
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), failing - len(gone), sum(x[0] == f for x in own), sum(x[1] for x in gone), sum(x[2] for x in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_audit_equals_brute_force(spark, monkeypatch):
    r = np.random.default_rng(8)
    base = texts(30) + EDGES + ["X1 Y2 Z3 " * 30, "tox # " * 60]
    rows = [(int(r.integers(0, 60)), base[int(r.integers(len(base)))], [None, "", "a", "b"][int(r.integers(4))]) for _ in range(200)]
    rows += [(None, "one", "a"), (None, "one", "a"), (None, None, None), (5, "only", "a"), (5, "only", "b"), (None, "lonely", "c")]
    labels = [(int(r.integers(0, 60)), int(r.integers(0, 2)), int(r.integers(0, 2))) for _ in range(40)] + [(3, None, 1), (3, 1, None), (None, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for chained in (300, 1 << 20):  # a task that passes its chains on early changes nothing
        monkeypatch.setattr(filter_audit, "CHAINED", chained)
        got = filter_audit.filter_audit(docs(spark, rows).repartition(5), frame).collect()
        assert len(got) == 600 * len({s or "" for _, _, s in rows})
        assert {(x.part, x.filter_order, x.step): tuple(x[3:]) for x in got} == brute_audit(rows, labels)
    assert filter_audit.filter_audit(docs(spark, []), frame).count() == 0


def test_chains_keep_texts_of_one_fingerprint_apart():
    c = filter_audit.Chains()
    assert list(c.add(1, "one", 5, None, {"a": 1})) == [] and list(c.add(1, "two", 6, None, {"a": 1})) == []
    assert [x[0] for x in c.add(1, "one", 3, None, {"b": 1})] == [5] and [x[0] for x in c.add(1, "two", None, None, {"a": 2})] == [None]
    assert sorted(x[:2] for x in c.by_hash[1]) == [["one", 3], ["two", 6]]


def conversations(seed=4, n=60):
    r = np.random.default_rng(seed)
    said = ["hello", "how are you", "well", "Bye é", ""]
    rows = []
    for c in r.choice(400, n, replace=False).tolist() + [1000, 1001, 1002, 1003, 1004, -7, -5]:
        for t in range(int(r.integers(1, 12))):
            rows.append((c, t if t or c % 3 else None, ["user", "assistant", None][int(r.integers(10)) % 3 if r.random() < 0.1 else t % 2], said[0 if r.random() < 0.6 else int(r.integers(5))] if t or c % 7 else None))
    rows += [(2000, 0, "user", "once"), (2000, 0, "user", "once"), (2000, 0, "user", "apart"), (None, 0, "user", "of nobody")]
    return rows


def brute_trie(rows):
    own = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    full = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        rest = abs(c) % 5 * (1 if c >= 0 else -1)
        full[c] = turns.get(c - rest, [])[:h] + turns[c][h:]
    members = collections.defaultdict(list)
    for c, s in full.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    out = []
    for key, own_members in members.items():
        below = [k for k in members if k[: len(key)] == key]
        leaves = [k for k in below if not any(len(q) == len(k) + 1 and q[: len(k)] == k for q in below)]
        ends = ",".join(map(str, sorted(c for c in own_members if len(full[c]) == len(key))))
        saved = sum((len(members[k]) - 1) * (len(k[-1][1].encode()) if k else 0) for k in below)
        out.append((min(own_members), len(key), min(members[key[:-1]]) if key else None, len(own_members), sum(len(k) == len(key) + 1 for k in below), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


CONV = "conv_id long, turn long, role string, text string, block int, place long, key string"


@pytest.mark.parametrize("blocks", ["1", "7", "40"])
def test_trie_equals_brute_force(spark, blocks, monkeypatch):
    """Also with as many blocks as two conversations fill, where most nodes reach over several."""
    monkeypatch.setattr(prefix_trie, "PIECE", 5)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", blocks)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = conversations()
        hot = [(3000 + i, t, "user", f"same {t}") for i in range(40) for t in range(3)]  # a conversation that many hold
        for given in (rows, rows + hot):
            frame = spark.createDataFrame([(*r, 1, 2, "k") for r in given], CONV)
            assert sorted(map(tuple, prefix_trie.conversation_trie(frame).collect()), key=str) == brute_trie(given)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_trie_of_nothing(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], CONV)).count() == 0
    only = spark.createDataFrame([(None, 0, "user", "of nobody", 1, 2, "k")], CONV)
    assert prefix_trie.conversation_trie(only).count() == 0


def test_nearest_smaller_blocks():
    r = np.random.default_rng(2)
    low = r.integers(-1, 5, 37).tolist()
    blocks = prefix_trie.Blocks([{"depth": x, "n_convs": 1, "n_leaves": 2, "shared": i, "n_children": x + 1, "conv_id": i * 13 % 37} for i, x in enumerate(low)])
    for i in range(37):
        for d in range(6):
            after = next((k for k in range(i + 1, 37) if low[k] < d), 37)
            before = next((k for k in range(i - 1, -1, -1) if low[k] < d), -1)
            assert (blocks.after(i, d), blocks.before(i, d)) == (after, before)
            least, children, (n, leaves, shared) = blocks.between(i + 1, after, d)
            inside = range(i + 1, after)
            assert (n, leaves, shared) == (len(inside), 2 * len(inside), sum(inside)) and children == sum(d + 1 for k in inside if low[k] == d)
            assert least == min((k * 13 % 37 for k in inside), default=None)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_substring_dedup", "op13_prefix_trie"])
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    got, want = queries.QUERIES[name](spark, DATA), c.execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(str, (tuple(r) for r in got.select(names).collect()))) == sorted(map(str, want.fetchall()))

"""Near-duplicate links of the sf0.1 documents against an exact join."""

import collections
import os
import re

import pytest

from tidewatch.llm import near_dedup

DOCUMENTS = "/root/testdata/sf0.1/documents.parquet"


def exact_links(sets: dict[int, frozenset], percent: int = 80):
    """All pairs of similar sets, by prefixes of the tokens in the order of rarity: two sets that are similar enough have one of the first
    n - ceil(n * percent / 100) + 1 in common."""
    often = collections.Counter(x for s in sets.values() for x in s)
    held = collections.defaultdict(list)
    for i, s in sorted(sets.items(), key=lambda x: len(x[1])):
        order = sorted(s, key=lambda x: (often[x], x))
        rare = order[: len(s) - -(-len(s) * percent // 100) + 1]
        for j in {j for x in rare for j in held[x] if 100 * len(sets[j]) >= percent * len(s)}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                yield min(i, j), max(i, j)
        for x in rare:
            held[x].append(i)


@pytest.mark.skipif(not os.path.isfile(DOCUMENTS), reason="no tables")
def test_links_of_an_exact_join_are_found(spark):
    docs = spark.read.parquet(DOCUMENTS)
    sets = {}
    for i, text in docs.select("doc_id", "text").collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        s = frozenset(hash(tuple(w[j : j + 5])) for j in range(len(w) - 4)) or (frozenset([hash(tuple(w))]) if w else frozenset())
        if s:
            sets[i] = s
    # equal sets are one class: a link to its first document stands for all
    first = {}
    alike = {i: first.setdefault(s, i) for i, s in sorted(sets.items())}
    links = set(exact_links({i: sets[i] for i in first.values()})) | {(j, i) for i, j in alike.items() if i != j}
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, k=5).collect()}
    found = sum(got[a] == got[b] for a, b in links)
    assert len(links) > 500 and found / len(links) >= 0.999
    # and nothing else is together
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    assert all(root(i) == root(got[i]) for i in sets)

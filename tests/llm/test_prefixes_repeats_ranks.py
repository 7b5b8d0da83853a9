"""Operators 11 to 13 by their registered queries, against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from martwell.llm import lexical, repeats, suffixes, trie
from martwell.session import new_scratch_dir


@pytest.fixture(scope="session")
def folder(spark):
    """A folder that holds the given frames as tables."""

    def write(**tables):
        path = new_scratch_dir(spark, "t-tables")
        for name, df in tables.items():
            df.write.parquet(f"{path}/{name}.parquet")
        return path

    return write


# ---- 11 ----------------------------------------------------------------------------------


def _trie_of(rows):
    told = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            told[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in told.items()}
    nodes = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            nodes[path[:d]].append((c, len(path)))
    children = Counter(p[:-1] for p in nodes if p)
    leaves, saved = Counter(), Counter()
    for p, m in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, m in nodes.items():
        ends = ",".join(str(c) for c, n in sorted(m) if n == len(p))
        parent = min(nodes[p[:-1]])[0] if p else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(m)[0], len(p), parent, len(m), children[p], leaves[p], saved[p], sha))
    return sorted(out, key=repr)


def _rows_of(df):
    return sorted((tuple(r[c] for c in trie.NODE_COLUMNS) for r in df.collect()), key=repr)


def test_prefix_trie_query(spark, folder, clashing):
    rnd = random.Random(2)
    rows = []
    for c in range(320):
        if c % 100 and rnd.random() < 0.1 or c == 100:
            continue  # conversations, and the first of a family, are missing
        n = rnd.choice([1, 1, 2, 3, 8, 40])
        rows += [(c, t, rnd.choice(["user", "user", None]), rnd.choice(["a", "bb", "", None, "é\U0001f642"])) for t in range(n)]
    rows += [(7, None, "system", "null turns come first"), (None, 0, "user", "no conversation"), (8, 2, "x", "tie")]
    rows += [(2**40 + 1, 0, "user", "a"), (9, 0, None, None), (9, 0, None, None)]
    rows = [r for r in rows if r != (8, 2, "x", "tie") or not any(q[:2] == (8, 2) for q in rows if q != r)]
    df = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert _rows_of(trie.op11_prefix_trie(spark, folder(conversations=df))) == _trie_of(rows)
    # many shards: nearly every node is on an edge
    small = trie.prefix_trie(trie.rebuilt(trie.paths(df)), shard_turns=5)
    assert _rows_of(small) == _trie_of(rows)
    one = trie.last_turns(small.filter("depth < 2"), trie.rebuilt(trie.paths(df)))
    assert one.filter("depth = 0 AND turn_id IS NULL").count() == 1
    assert trie.op11_prefix_trie(spark, folder(conversations=df.limit(0))).count() == 0


def test_prefix_trie_of_equal_and_long_paths(spark):
    turns = [(c, t, "user", "same" if t < 300 else f"{c % 3}") for c in range(30) for t in range(301)]
    told = trie.paths(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    nodes = trie.prefix_trie(told, shard_turns=700).collect()
    at = {(r.depth, r.conv_id): r for r in nodes}
    assert len(nodes) == 301 + 3 and at[0, 0].n_leaves == 3 and at[300, 0].n_children == 3
    assert at[300, 0].saved_tokens == 29 * 4 + 3 * 9 and at[0, 0].saved_tokens == 300 * 29 * 4 + 3 * 9
    want = ",".join(str(c) for c in range(1, 30, 3))
    assert at[301, 1].ends_sha256 == hashlib.sha256(want.encode()).hexdigest() and at[301, 1].parent_conv_id == 0


# ---- 12 ----------------------------------------------------------------------------------


@pytest.mark.parametrize("many", [1, 200])
def test_suffix_array_and_common_prefixes(many, monkeypatch):
    monkeypatch.setattr(suffixes, "MANY", many)
    rnd = random.Random(many)
    for _ in range(400):
        data = bytes(rnd.randrange(rnd.choice([1, 2, 3, 20])) for _ in range(rnd.randint(0, 60)))
        s = np.frombuffer(data, np.uint8)
        sa = suffixes.suffix_array(s)
        assert sa.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
        if data:
            before, shared = suffixes.common_prefixes(s, sa)
            for a, b in zip(sa[:-1].tolist(), sa[1:].tolist()):
                x, y = data[a:], data[b:]
                n = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
                assert (before[b], shared[b]) == (a, n)


def test_induced_one_by_one_equals_whole_buckets():
    rnd = random.Random(11)
    for kind in (np.uint8, np.int64):
        for _ in range(200):
            s = np.array([rnd.randrange(rnd.choice([1, 2, 30, 250])) for _ in range(rnd.randint(2, 80))]).astype(kind)
            small = suffixes._types(s)
            places = np.flatnonzero(small[1:] & ~small[:-1]) + 1
            rnd.shuffle(places)
            found = [f(s, small, places, np.bincount(s)) for f in (suffixes._induced_one_by_one, suffixes._induced_by_bucket)]
            assert found[0].tolist() == found[1].tolist()


def _without_repeats(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), len(edge) // 2, hashlib.sha256(kept).hexdigest()))
    return out


def _texts():
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, line = prose(150), prose(40)
    texts = [prose(rnd.randint(1, 400)) for _ in range(25)]
    texts += [f"{prose(rnd.randint(0, 30))} {passage[: rnd.randint(300, 900)]} {prose(20)}" for _ in range(30)]
    texts += [f"{prose(5)} {line} {prose(rnd.randint(5, 90))}" for _ in range(20)]
    base = prose(300)
    for _ in range(12):
        w = base.split()
        w[rnd.randrange(len(w))] = word()
        texts.append(" ".join(w))
    texts += [base, base, base, "x" * 5000, "ab" * 900, (line + "\n") * 12, "", None, "x" * 400, "y" * 399, "z" * 401]
    return texts


def test_repeat_removal_query(spark, folder, clashing):
    texts = _texts()
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[4]), (None, texts[5])]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = repeats.op12_repeat_removal(spark, folder(documents=df)).collect()
    want = _without_repeats([(t or "").encode() for _, t in rows], 400)
    have = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr)
    assert have == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=repr)
    assert repeats.op12_repeat_removal(spark, folder(documents=df.limit(0))).count() == 0


@pytest.mark.parametrize(("length", "most"), [(400, 2), (60, 3), (1, 2)])
def test_anchors_with_many_pieces_are_split(spark, length, most):
    texts = [t[:600] if t else t for t in _texts()] if length < 100 else _texts()
    if length == 1:
        texts = ["abc", "cde", "", "f", "gg"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in repeats.remove_repeats(df, length=length, most=most).collect()}
    raws = [(t or "").encode() for t in texts]
    for i, w in enumerate(_without_repeats(raws, length)):
        r, spans = got[i], [(s.start, s.end) for s in got[i].spans]
        assert (r.n_bytes, sum(b - a for a, b in spans), len(spans), hashlib.sha256(r.kept).hexdigest()) == w


def test_pieces_cover_every_window_once(monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 700)
    rnd = random.Random(5)
    docs = [bytes(rnd.randrange(97, 100) for _ in range(n)) for n in (0, 3000, 399, 400, 1, 401, 900)]
    ends = np.cumsum([len(d) for d in docs])
    first, stop, anchor, _ = repeats.cut(np.frombuffer(b"".join(docs), np.uint8), ends)
    windows = [w for a, b in zip(first.tolist(), stop.tolist()) for w in range(a, b)]
    want = [e - len(d) + i for d, e in zip(docs, ends.tolist()) for i in range(len(d) - 399)]
    assert windows == want
    assert all(a >= s - 1 and a + repeats.gram(400) <= f + 400 for f, s, a in zip(first, stop, anchor))


# ---- 13 ----------------------------------------------------------------------------------

_TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _ranks(docs, items, k):
    cut = lambda t: Counter(_TERM.findall((t or "").translate(_LOWER)))
    told = [(i, c) for i, c in ((i, cut(t)) for i, t in docs) if c]
    n, words = len(told), sum(c.total() for _, c in told)
    df = Counter(t for _, c in told for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in told:
            m = 25 + (75 * c.total() * n) // words
            score = sum(
                r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t, r in cut(text).items() if t in c
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, i, None if no else doc, -s) for i, (s, no, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def _search_rows():
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(60)] + ["É", "é", "Zz", "zZ", "x_y", "naïve", "漢字", "\U0001f642", "7"]
    text = lambda n: "".join(rnd.choice(words) + rnd.choice([" ", ", ", "\n", "-", "\x00"]) for _ in range(n))
    docs = [(i, text(rnd.choice([0, 1, 5, 30, 200]))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, " ,. \n"), (None, docs[5][1]), (5, docs[5][1]), (300, docs[9][1]), (203, "w1 " * 30_000)]
    items = [(i, text(rnd.randint(1, 12))) for i in range(12)] + [(50, None), (51, ""), (52, "unseen words only"), (None, "w1 w2"), (3, "w3 w3 W3")]
    return docs, items


def test_ranked_search_query(spark, folder, clashing, monkeypatch):
    docs, items = _search_rows()
    d = clashing(spark.createDataFrame(docs, "doc_id long, text string"))
    q = clashing(spark.createDataFrame(items, "item_id long, text string"))
    want = _ranks(docs, items, 10)

    def rows(df):
        return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=repr)

    path = folder(documents=d, benchmark=q)
    assert rows(lexical.op13_ranked_search(spark, path)) == want
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 5)
    monkeypatch.setattr(lexical, "FIRST_ROWS", 20)
    monkeypatch.setattr(lexical, "BUCKET_ROWS", 7)
    assert rows(lexical.op13_ranked_search(spark, path)) == want
    for some in ({"documents": d.limit(0), "benchmark": q}, {"documents": d, "benchmark": q.limit(0)}):
        assert lexical.op13_ranked_search(spark, folder(**some)).count() == 0


def test_buckets_are_pruned_without_loss():
    rnd = np.random.default_rng(3)
    n, terms = 4000, 50
    held = [np.sort(rnd.choice(terms, rnd.integers(1, 12), replace=False)).astype(np.int32) for _ in range(n)]
    values = [rnd.integers(1, 1000, len(h)) for h in held]
    norm = np.array([math.sqrt(float((v.astype(float) ** 2).sum())) for v in values])
    order = np.argsort(-norm, kind="stable")
    query, weight = np.array([3, 9, 17]), np.array([700, 40, 300])
    dense = np.zeros((n, terms), np.int64)
    for i, (h, v) in enumerate(zip(held, values)):
        dense[i, h] = v
    score = dense[:, query] @ weight
    want = sorted(zip((-score).tolist(), range(n)))[:10]
    search = lexical.Search([query], [weight], [0], 10)
    for at in range(0, n, 250):
        some = order[at : at + 250]
        none = np.zeros(len(some), bool)
        search.add(
            lexical.Bucket(some, some, none, [held[i].tobytes() for i in some], [values[i].tobytes() for i in some], norm[some])
        )
    got = [(-s, d) for s, d in zip(search.best[0][0].tolist(), search.best[0][2].tolist())]
    assert got == want
    assert search.skipped and search.scored < n / 2  # some buckets are passed over, and most rows of the others

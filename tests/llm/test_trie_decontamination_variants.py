"""Prefix trie, decontamination and spelling variants on small tables with
nulls, empty and long texts, ties, repeated rows and clashing columns, against
plain Python."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaestor.llm import decontamination, trie, variants

# ------------------------------------------------------------------ prefix trie

CONV = "conv_id long, turn long, role string, text string, p long, place int, shard string, depth int"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "s", 3) for r in rows], CONV).repartition(4)


def plain_trie(rows):
    def md(role, text):
        d = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
        return int(d[:15], 16), int(d[15:30], 16)

    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", md(role or "", text or ""), text or ""))
    own = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members = {}
    for c, w in whole.items():
        for d in range(len(w) + 1):
            members.setdefault(w[:d], []).append(c)
    out = []
    for path, cs in members.items():
        below = [p for p in members if p[:len(path)] == path]
        leaf = [p for p in below if not any(len(x) == len(p) + 1 and x[:len(p)] == p for x in members)]
        ends = ",".join(map(str, sorted(c for c in cs if whole[c] == path)))
        out.append((min(cs), len(path), min(members[path[:-1]]) if path else None, len(cs),
                    sum(1 for p in members if len(p) == len(path) + 1 and p[:-1] == path), len(leaf),
                    sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def got_trie(spark, rows, **sizes):
    df = trie.trie(*trie.rebuilt(trie.turns_of(conversations(spark, rows))), **sizes)
    return sorted((tuple(r[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                                        "ends_sha256")) for r in df.collect()), key=lambda r: r[:2])


def odd_conversations():
    rng = random.Random(4)
    rows = []
    for c in [*range(0, 14), 100, 105, 205, 207, 999]:  # 205, 207 and 999 have no conversation to begin with
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bé", ""])))
    rows += [(300, t, "user", f"same {t}") for t in range(8)] + [(c, t, "user", f"same {t}") for c in range(301, 320) for t in range(8)]
    rows += [(400, None, "user", "first"), (400, 5, None, None), (400, 5, "user", "x"), (400, 5, "user", "x"), (400, 5, "b", "y"),
             (None, 1, "user", "no id"), (500, 0, "user", "z" * 30_000)]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"segment": 2}])
def test_trie_equals_plain_python(spark, sizes):
    rows = odd_conversations()
    assert got_trie(spark, rows, **sizes) == plain_trie(rows)


def test_trie_of_turnless_conversations_and_of_none(spark):
    # one turn, more than one to take from a conversation that is not there
    alone = next(c for c in range(701, 760) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = [(alone, 0, "user", "gone")]
    got = got_trie(spark, rows)
    assert got == plain_trie(rows) and len(got) == 1 and got[0][-1] == hashlib.sha256(str(alone).encode()).hexdigest()
    assert got_trie(spark, [(None, 0, "user", "x")]) == []


def test_turns_of_one_long_conversation_are_numbered_over_partitions(spark):
    rows = conversations(spark, [(7, t, "user", str(t)) for t in range(500)] + [(8, 0, "user", "x")])
    got = trie.turns_of(rows).where("conv_id = 7").collect()
    assert sorted(r.place for r in got) == list(range(1, 501))


def test_node_table_is_minimal_perfect_and_knows_strangers():
    rng = np.random.default_rng(3)
    p, q = rng.integers(-2**62, 2**62, 20_000), rng.integers(-2**62, 2**62, 20_000)
    t = trie.NodeTable(p, q)
    assert sorted(t.slots(p, q)) == list(range(20_000))
    assert (t.slots(q, p) == -1).all()
    with pytest.raises(ValueError):
        trie.NodeTable(np.zeros(2, np.int64), np.zeros(2, np.int64))


# ------------------------------------------------------------------ decontamination

def words_of(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_hits(docs, items, window):
    out = []
    for doc_id, text in docs:
        w, hit, found = words_of(text), set(), set()
        for item_id, it in items:
            x = words_of(it)
            span = min(window, len(x))
            if item_id is None or not x:
                continue
            kinds = {tuple(x[i:i + span]) for i in range(len(x) - span + 1)}
            for i in range(len(w) - span + 1):
                if tuple(w[i:i + span]) in kinds:
                    hit.update(range(i, i + span))
                    found.add(str(item_id))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


DOCS = "doc_id long, text string, n_words int, row int, item_id string, shingle int, places int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "x", 3, 4) for i, t in rows], DOCS).repartition(3)


@pytest.mark.parametrize("window,shingle,small", [(10, 3, 1 << 20), (4, 2, 0), (3, 3, 0), (2, 5, 1 << 20)])
def test_decontamination_equals_plain_python(spark, monkeypatch, window, shingle, small):
    monkeypatch.setattr(decontamination, "SMALL", small)
    rng = random.Random(window)
    some = ["ab", "Cd", "é", "x1", "漢字", "the"]
    items = [(i, " ".join(rng.choice(some) for _ in range(rng.randrange(1, 25)))) for i in range(12)]
    items += [(3, "one more under the same id"), (None, "ab ab"), (77, None), (78, ""), (79, "..."), (-5, "word")]
    docs = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choice(some) for _ in range(rng.randrange(0, 40)))) for i in range(60)]
    docs += [(100 + i, f"a b {t} c-d {t.upper()}") for i, (_, t) in enumerate(items) if t]
    docs += [(None, "no id"), (1, None), (1, ""), (1, "word"), (1, "word"), (2, "ab " * 30_000 + (items[0][1])), (3, "word" * 9000)]
    got = decontamination.decontaminate(frame(spark, docs), frame(spark, items).select("text", F.col("doc_id").alias("item_id"), "n_words"),
                                        window, shingle).collect()
    assert sorted(map(tuple, got), key=str) == plain_hits(docs, items, window)


def test_decontamination_of_empty_tables(spark):
    docs, none = frame(spark, [(1, "some words of a text")]), frame(spark, [(1, "x")]).where("false")
    items = docs.select(F.lit(4).alias("item_id"), "text")
    assert decontamination.decontaminate(none, items).count() == 0
    got = decontamination.decontaminate(docs, items.where("false")).collect()
    assert [tuple(r) for r in got] == [(1, 5, 0, 0, hashlib.sha256(b"").hexdigest(), False)]


# ------------------------------------------------------------------ spelling variants

def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_groups(words, ratio=10):
    out, forms = {}, {}
    for w, n in words.items():
        around = [x for x in words if near(w, x)]
        best = min(around, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= ratio * n else None
        out[w] = [w, form, None, n, len(around), words[form] if form else None]
        forms[w] = form
    for w, row in out.items():
        root = w
        while forms[root]:
            root = forms[root]
        row[2] = root
    return sorted(map(tuple, out.values()))


def test_acceptor_composition_equals_all_pairs():
    rng = random.Random(1)
    for _ in range(200):
        ws = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(6))) for _ in range(rng.randrange(1, 20))})
        found = [tuple(sorted(p)) for p in variants.Acceptor(ws).one_edit()]
        assert len(found) == len(set(found)) and set(found) == {p for p in itertools.combinations(ws, 2) if near(*p)}


def test_acceptor_is_minimal():
    a = variants.Acceptor(sorted(x + y for x in "abc" for y in ("ing", "ed", "er")))
    assert len(a.arcs) == 6  # start, before the endings, i-, in-, e-, end


@pytest.mark.parametrize("most", [3, 100_000])
def test_groups_equal_all_pairs(spark, most):
    rng = random.Random(most)
    words = {}
    for _ in range(40):
        w = "".join(rng.choice("abé") for _ in range(rng.randrange(7, 10)))
        words[w] = rng.choice([2, 30, 400, 5000])
        for _ in range(4):
            i, c = rng.randrange(len(w)), rng.choice("abé")
            v = rng.choice([w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:]])
            if len(v) >= 7:
                words[v] = rng.choice([2, 3, 30, 30, 400])
    words |= {"a" * n: 10 ** (13 - n) for n in range(7, 12)} | {"x" * 3000: 2, "x" * 3001: 20}
    got = variants.group(spark.createDataFrame(list(words.items()), "word string, n long").repartition(3), most=most)
    assert sorted(tuple(r) for r in got.collect()) == plain_groups(words)


def test_vocabulary_counts_runs_and_deletes_by_hash(spark):
    rng = random.Random(8)
    texts = [(rng.choice([None, i, i % 5]), " ".join(rng.choice(["Although", "LIBERTÉ", "×naïveté÷", "short", "seven77letters", "straße-Straßen"])
                                                  for _ in range(30))) for i in range(80)]
    texts += [(1, None), (2, ""), (3, "z" * 20_000), (4, "z" * 20_000), (5, "Although " * 40_000)]
    want = Counter()
    for i, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                want[run] += 1
    got = variants.vocabulary(frame(spark, texts)).collect()
    assert {r.word: r.n for r in got} == {w: n for w, n in want.items() if n >= 2}
    assert variants.group(variants.vocabulary(frame(spark, texts).where("false"))).count() == 0

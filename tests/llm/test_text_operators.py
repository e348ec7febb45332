"""Each operator on small tables with nulls, empty and long texts, repeated
rows and clashing columns, against a plain Python version."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaestor.llm import bpe, html_text, language, licenses, lines, minhash, packing, quality, resharding
from quaestor.llm.tokens import public_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words int, blocks int, node string"


def frame(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "en", "s", 0, 1, 2, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def prose(seed, n=120):
    rng = random.Random(seed)
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "the", "of", "naïve", "don't", "x1", "zeta,"])
                    + ("\n" if rng.random() < 0.1 else "") for _ in range(n))


ODD = [None, "", " ", "\n\n", "one", "a  b", " lead", "trail ", "tab\tnew\n line", "<|endoftext|> in <|endoftext|>",
       "x" * 5000, "…’“ ﬁ Ⅳ ① é é  한글 漢字" * 40, "don't we'll I'd they've 'l l 'll", "1234567 89", "same", "same"]


@pytest.fixture(scope="module")
def texts():
    body = prose(1, 400)
    shared = [f"{prose(s, 30)} {body} {prose(s + 50, 30)}" for s in range(6)]
    return ODD + shared + [body, body, body.replace("alpha", "omega", 1)] + [prose(s) for s in range(20, 26)]


def test_bpe_round_trip_equals_library(spark, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    want = sorted((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                   hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest())
                  for i, t in enumerate(texts)
                  for ids in [tok.encode(t or "", add_special_tokens=False).ids])
    docs = frame(spark, texts)
    got = bpe.encode_decode(docs.unionAll(docs.where("doc_id = 3")), whole=False).collect()
    assert sorted(map(tuple, got)) == sorted(want + [want[3]])
    assert bpe.encode_decode(docs.where("false")).count() == 0


def test_decode_replaces_bad_bytes_like_library():
    from tokenizers import Tokenizer

    from quaestor.llm.tokens import PieceEncoder

    enc, tok = PieceEncoder(public_path("byte_bpe_50k.json"), "byte"), Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    rng = random.Random(5)
    for _ in range(300):
        ids = [rng.randrange(tok.get_vocab_size()) for _ in range(rng.randrange(12))]
        assert enc.decode(np.array(ids, "<u4").tobytes()) == tok.decode(ids, skip_special_tokens=False)


def test_chunks_follow_content_and_joints_are_exact():
    from quaestor.llm.tokens import PieceEncoder

    text = prose(3, 3000)
    ends, moved = bpe.chunk_ends(text), bpe.chunk_ends("some words before " + text)
    assert len(ends) > 5 and len({e + 18 for e in ends} & set(moved)) > len(ends) / 2
    enc = PieceEncoder(public_path("byte_bpe_50k.json"), "byte")
    for t in [text, "漢字" * 3000, "a " * 4000 + " \n b" * 50]:
        cut = bpe.chunk_ends(t)
        parts = [(a, b, enc.encode([t[a:b]])[0]) for a, b in zip([0, *cut], cut)]
        assert bpe.joined(enc, t, parts) == enc.encode([t])[0]


def test_packing_lays_every_id_once(spark, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    ids = {i: np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in enumerate(texts)}
    got = packing.pack(frame(spark, texts), size=256, open_windows=3, fan_in=2).collect()
    at, filled = {i: 0 for i in ids}, {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        piece = ids[r.doc_id][r.start:r.start + r.length]
        assert r.start == at[r.doc_id] and r.doc_tokens == len(ids[r.doc_id]) and len(piece) == r.length
        assert r.ids_crc32 == zlib.crc32(piece.tobytes()) and bytes(r.ids) == piece.tobytes()
        at[r.doc_id] += r.length
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert at == {i: len(x) for i, x in ids.items()}
    for places in filled.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
    assert sum(sum(n for _, n in p) < 256 for p in filled.values()) <= 1
    assert packing.pack(frame(spark, texts).where("false")).count() == 0


def test_near_duplicates_equal_brute_force(spark, texts):
    variants = [" ".join(w if random.Random(s * 1000 + i).random() > 0.02 else f"new{s}" for i, w in
                         enumerate(prose(77, 300).split())) for s in range(40)]
    all_ = texts + [prose(77, 300)] + variants
    sets = []
    for t in all_:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set())
    root = list(range(len(all_)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    got = {r.doc_id: r for r in minhash.near_duplicates(frame(spark, all_), 3, (85, 100)).collect()}
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(s), find(i), find(i) == i) for i, s in enumerate(sets)}
    assert minhash.near_duplicates(frame(spark, all_).where("false")).count() == 0


def test_components_of_paths_and_hubs(spark):
    from quaestor.llm.components import connected_components

    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(40)}, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("least", [1, 3])
def test_removed_lines_equal_brute_force(spark, least, monkeypatch):
    if least == 3:  # no side of a join is small
        monkeypatch.setattr(lines, "SMALL", -1)
    rng = random.Random(9)
    base = [" ".join(rng.sample([f"w{i}" for i in range(60)] + ["the", "of"], rng.randrange(3, 25))) for _ in range(30)]

    def near(line):
        w = line.split()
        w[rng.randrange(len(w))] = f"v{rng.randrange(9)}"
        return " ".join(w).upper() if rng.random() < 0.3 else " ".join(w)

    texts = ["\n".join(rng.choice(base) if rng.random() < 0.4 else near(rng.choice(base)) for _ in range(8))
             for _ in range(40)] + [None, "", "one two\none two", "\n\n", texts_line := "a b c d\n\ta  b c D "]
    rows = [(i, n, frozenset(re.findall(r"[^\x20\x09-\x0D]+", x.lower())))
            for i, t in enumerate(texts) for n, x in enumerate((t or "").split("\n"))]
    rows = [r for r in rows if len(r[2]) >= least]
    rule = {} if least == 1 else {"min_tokens": least}  # every line with a word by default
    gone = {r[:2] for k, r in enumerate(rows)
            if any(5 * len(r[2] & q[2]) >= 4 * len(r[2] | q[2]) for q in rows[:k])}
    docs = frame(spark, texts)
    got = {(r.doc_id, r.line_no) for r in lines.removed_lines(lines._source(docs, "doc_id", "text"), **rule).collect()}
    assert got == gone and texts_line
    cut = {r.doc_id: r for r in lines.dedup(docs, **rule).collect()}
    assert len(cut) == len(texts) and cut[40].text is None
    for i, t in enumerate(texts):
        if t is not None:
            assert cut[i].text == "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone)
    assert lines.dedup(docs.where("false")).count() == 0 and lines.dedup(docs).columns == docs.columns


def test_removed_lines_of_sizes_in_all_bands(spark):
    rng = random.Random(5)
    texts, space = [], [" ", "  ", "\t", " \x0b", "\f", "\r"]
    for n in (*range(1, 24), 30, 31, 47, 60, 61, 120, 240):
        words = [f"b{n % 5}x{i}" for i in range(n)]
        for m in {n, n * 4 // 5, -(-4 * n // 5), n * 5 // 4, -(-5 * n // 4)}:
            part = (words + [f"c{n}y{i}" for i in range(m)])[:m]
            rng.shuffle(part)
            texts.append(rng.choice(["", " "]) + "".join(w.upper() + rng.choice(space) for w in part))
    rng.shuffle(texts)
    sets = [frozenset(re.findall(r"[^\x20\x09-\x0D]+", t.lower())) for t in texts]
    gone = {(k, 0) for k, a in enumerate(sets) if a and any(5 * len(a & b) >= 4 * len(a | b) for b in sets[:k])}
    docs = lines._source(frame(spark, texts), "doc_id", "text")
    assert {(r.doc_id, r.line_no) for r in lines.removed_lines(docs).collect()} == gone
    # parity bits: no more of them differ than tokens do
    by = {r.doc_id: r for r in lines._lines(docs, 4, 5, 1).where('n is not null').collect()}
    for (i, a), (j, b) in zip(enumerate(sets), list(enumerate(sets))[1:]):
        if i in by and j in by:
            assert by[i].n == len(a)
            assert sum(bin((by[i][c] ^ by[j][c]) % 2**64).count("1") for c in ("b0", "b1")) <= len(a ^ b)


def test_second_rows_of_a_band_are_fewer(spark):
    # only the smaller one of a pair goes to another band, with the 1/9 of its tokens that it needs there
    sets = spark.range(4, 400).selectExpr("cast(id as int) n", "sequence(1, cast(id - (4 * id + 4) div 5 + 1 as int)) prefix")
    rows = lines._banded(sets, 4, 5).selectExpr("n", "band", "size(prefix) p").collect()
    own = {n: min(r.band for r in rows if r.n == n) for n in range(4, 400)}
    assert all(r.p == r.n - -(-4 * r.n // 5) + 1 for r in rows if r.band == own[r.n])
    more = [r for r in rows if r.band != own[r.n]]
    assert more and all(r.p == r.n - -(-8 * r.n // 9) + 1 for r in more)


def test_query_and_pipeline_remove_copies_of_short_lines(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(3)
    texts = ["\n".join(" ".join(rng.choice("abcd") for _ in range(rng.randrange(1, 6))) for _ in range(6)) for _ in range(12)]
    texts += ["Share\nRead more\n--", "share \nmore read\n\n--", "only\nRead"]
    rows = [(i, n, frozenset(x.lower().split())) for i, t in enumerate(texts) for n, x in enumerate(t.split("\n"))]
    gone = {r[:2] for k, r in enumerate(rows)
            if r[2] and any(5 * len(r[2] & q[2]) >= 4 * len(r[2] | q[2]) for q in rows[:k])}
    assert {(13, 0), (13, 1), (13, 3)} <= gone
    docs = frame(spark, texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    told = lines.query(spark, str(tmp_path)).collect()
    assert {(r.doc_id, n) for r in told for n in r.removed} == gone
    cut = {r.doc_id: r.text for r in corpus_pipeline.cut_repeated_lines(spark, docs, str(tmp_path)).collect()}
    left = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in enumerate(texts)}
    assert cut == {i: t for i, t in left.items() if t.strip()}


def test_quality_metrics_equal_plain_python(spark, texts):
    more = ["the same three " * 30, "a a a a", "\n".join(["line one here", "line two", "line one here"]), "%%% $$ " * 60,
            "LOUD!! " * 80]
    all_ = texts + more
    got = {r.doc_id: r for r in quality.metrics(frame(spark, all_)).collect()}
    for i, t in enumerate(all_):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        win = [tuple(w[j:j + 3]) for j in range(len(w) - 2)]
        cover = {j + d for j, x in enumerate(win) if win.count(x) > 1 for d in range(3)}
        ls = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(w) < 50 or 100 * len(cover) > 50 * len(w)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(ls) - len(set(ls)), len(cover), failed), i
        assert not (failed and r.kept)
    docs = frame(spark, all_)
    assert sorted(r.doc_id for r in quality.kept_rows(docs).collect()) == sorted(i for i, r in got.items() if r.kept)
    assert quality.kept_rows(docs).columns == docs.columns
    assert quality.metrics(docs.where("false")).count() == 0


def test_licenses(spark):
    texts = ODD + ["Released under the MIT License.", "mit-license MIT LICENSE, cc by cc by 4.0 cc-by",
                   "word " * 300 + "licensed under the Apache License, version 2.0; you may not use this file except in "
                   "compliance with the License" + " word" * 300,
                   "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                   "and its associated documentation files"]
    got = {r.doc_id: r for r in licenses.scan(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        at = [(k, lab) for p, lab in licenses.PHRASES.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(w), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None),
            ",".join(sorted({x for _, x in at}))), i
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    n = len(ODD)
    assert got[n + 3].labels == "mit" and got[n + 3].n_base == 0 and got[n + 3].score > 0.8
    assert got[n + 2].labels == "apache" and got[n + 1].labels == "cc-by,mit" and got[0].labels == ""
    assert licenses.scan(frame(spark, texts).where("false")).count() == 0


def test_license_template_must_fit_half_a_block(spark):
    body = " ".join(f"w{i}" for i in range(100))
    docs = frame(spark, ["x " * 41 + body + " y" * 41])
    with pytest.raises(ValueError):
        licenses.scan(docs, [("long", body)])
    assert licenses.scan(docs, [("long", body)], block_words=200).first().labels == "long"


def test_resharding_moves_least_and_numbers_without_gaps(spark):
    rng = random.Random(2)
    texts = [None, ""] + ["ä" * rng.randrange(1, 400) for _ in range(3000)] + ["same"] * 1500
    docs = frame(spark, texts, ids=[None, 5] + [rng.randrange(9000) for _ in range(3000)] + [77] * 1500)
    old = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(8))
    got = resharding.reshard(resharding.sized(docs), old, 8, resharding.equal_capacities(10)).toPandas()
    assert len(got) == len(texts)
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 10 and sizes.max() - sizes.min() < 0.06 * sizes.mean()
    before, mean = got.groupby("old_shard")["size"].sum(), got["size"].sum() / 10
    least = sum(max(0, s - mean) for s in before)
    assert got[got.shard != got.old_shard]["size"].sum() <= 1.1 * least + mean * 0.1
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert set(got[got["size"] == 16].text_crc32) == {0}
    empty = resharding.reshard(resharding.sized(docs.where("false")), old, 8, resharding.equal_capacities(10))
    assert empty.count() == 0


def test_min_cost_flow_against_every_split():
    cost = [[0, 3, 1], [2, 0, 5]]
    flow = resharding.min_cost_flow([4, 3], [3, 2, 2], lambda i, j: cost[i][j])
    total = sum(cost[i][j] * n for (i, j), n in flow.items())
    best = min(cost[0][0] * a + cost[0][1] * b + cost[0][2] * (4 - a - b)
               + cost[1][0] * (3 - a) + cost[1][1] * (2 - b) + cost[1][2] * (2 - 4 + a + b)
               for a in range(4) for b in range(3) if 0 <= 4 - a - b <= 2)
    assert total == best and sum(flow.values()) == 7
    with pytest.raises(ValueError):
        resharding.min_cost_flow([4], [3], lambda i, j: 1)


def test_language_held_out_accuracy_and_odd_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.train(language.training_rows(docs))
    told = language.identify(docs, model, ["doc_id", "lang"]).where(language.held_out("doc_id")).collect()
    assert len(told) > 20 and sum(r.lang == r.lang_pred for r in told) >= 0.95 * len(told)
    odd = frame(spark, ODD + ["123 --- !!", "word " * 20_000])
    got = {r.doc_id: r for r in language.identify(odd, model, ["doc_id", "words"]).collect()}
    assert len(got) == len(ODD) + 2
    for i in (0, 1, 2, 3, len(ODD)):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in got.values()) and got[len(ODD) + 1].lang_pred in model.languages
    assert language.accepted_rows(odd, model).columns == odd.columns
    nothing = language.train(language.training_rows(docs.where("false")))
    assert {r.lang_pred for r in language.identify(odd, nothing, ["doc_id"]).collect()} == {"und"}


def test_accepted_rows_reject_languages_not_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 500")
    model = language.train(language.training_rows(docs).where("lang <> 'de'"))
    rng = random.Random(4)
    planted = {
        -1: "Все люди рождаются свободными и равными в своем достоинстве и правах и наделены разумом и совестью. " * 5,
        -2: "มนุษย์ทั้งหลายเกิดมามีอิสระและเสมอภาคกัน " * 60,
        -3: "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren, begiftigd met verstand en geweten. " * 5,
        -4: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9))) for _ in range(90)),
    }
    held = docs.where(language.held_out("doc_id")).select("doc_id", "text", "lang")
    rows = held.unionByName(spark.createDataFrame([(i, t, "none") for i, t in planted.items()], held.schema))
    n, kept = [{r.lang: r["count"] for r in x.groupBy("lang").count().collect()}
               for x in (rows, language.accepted_rows(rows, model))]
    assert "none" not in kept and kept.get("de", 0) <= 0.1 * n["de"]
    assert all(kept[k] >= 0.95 * n[k] for k in ("en", "es", "fr"))


def test_word_probability_sums_all_segmentations():
    pieces = ["a", "b", "ab", "ba", "aba", "▁", "▁a"]
    p = np.array([[0.2], [0.1], [0.3], [0.05], [0.02], [0.1], [0.15]])
    model = language.Model(["x"], pieces, p)
    prob = dict(zip(pieces, p[:, 0]))

    def total(w):
        return 1.0 if not w else sum(prob[w[:n]] * total(w[n:]) for n in range(1, len(w) + 1) if w[:n] in prob)

    for w in ("▁aba", "▁abab", "▁bbaab"):
        assert np.isclose(np.exp(model._words([w])[0, 0]), total(w))


def test_long_pieces_and_long_words_count_whole():
    import math

    pieces = ["a", "b", "ab", "ba", "▁", "▁abbaabbaab", "bbbbbbbbbbbbbbbb"]
    p = np.array([[0.2, 0.1], [0.1, 0.2], [0.3, 0.01], [0.05, 0.1], [0.1, 0.1], [0.15, 0.001], [0.001, 0.2]])
    model = language.Model(["x", "y"], pieces, p)
    rng = random.Random(8)
    words = ["▁abbaabbaab", "▁" + "b" * 40, "▁abz", *("▁" + "".join(rng.choice("abbz") for _ in range(n)) for n in (33, 50, 3000))]
    got = model._words(words)
    for w, row in zip(words, got):
        for k in (0, 1):
            prob, logs = dict(zip(pieces, p[:, k])), [0.0]
            for end in range(1, len(w) + 1):
                terms = [logs[end - n] + math.log(prob[w[end - n:end]]) for n in range(1, min(end, 16) + 1) if w[end - n:end] in prob]
                if w[end - 1] not in prob:
                    terms.append(logs[end - 1] + math.log(language.UNKNOWN))
                logs.append(max(terms) + math.log(sum(math.exp(t - max(terms)) for t in terms)))
            assert np.isclose(row[k], logs[-1], rtol=1e-9, atol=0)
    model.AT_ONCE = 100  # a long word's lookups come in parts
    assert np.allclose(model._words(words), got, rtol=1e-12, atol=0)


def test_training_counts_all_pieces(spark):
    docs = spark.createDataFrame([(1, "the government " * 40, "en"), (3, "die Information " * 40, "de")],
                                 "doc_id long, text string, lang string")
    model = language.train(docs)
    at = {p: i for i, p in enumerate(model.hashes.tolist())}
    for piece, best in (("▁government", 1), ("▁Information", 0)):
        row = model.probabilities[at[model._hash(piece)]]
        assert row.argmax() == best and row.max() > 100 * row.min()


def test_training_reads_whole_texts(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_path("piece_bpe_32k.model"))
    text = "".join(prose(s, 400) + random.Random(s).choice(["  ", " ", "\n", "\t "]) for s in range(30)) + " zebra" * 500
    assert len(text) > 2.5 * language.SLICE_CHARS
    assert [i for part in language._slices(text, 700) for i in sp.encode(part)] == sp.encode(text)
    model = language.train(spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string"))
    at = {p: i for i, p in enumerate(model.hashes.tolist())}
    want = sum(n == sp.encode("zebra")[0] for n in sp.encode(text))
    total = sum(not (sp.is_byte(n) or sp.is_control(n) or sp.is_unknown(n)) for n in sp.encode(text))
    got = model.probabilities[at[model._hash(sp.id_to_piece(sp.encode("zebra")[0]))], 0]
    assert want >= 500 and np.isclose(got, (want + 0.1) / (total + 0.1 * len(model.hashes)))


def test_html_text():
    page = html_text.visible_text(
        "<title>no</title><h1>Head <b>bold</b></h1>intro<p>one<p>two<br>three<ul><li>a<li>b<ul><li>c</ul></ul>"
        "<ol start=3><li>x<li><p>y</ol><table><tr><th>Name<th>V<tr><td>alpha<td>1<tr><td>b<td>22</table>"
        "<pre>\n a  b\n  c</pre><div style='display: none'>no</div><p hidden>no</p><script>if (a<b) no</script>"
        "tail &amp; more<!-- no --> end<dialog>no</dialog>")
    assert page == ("Head bold\n\nintro\n\none\n\ntwo\nthree\n\n- a\n- b\n  - c\n\n3. x\n4. y\n\nName  | V\nalpha | 1\n"
                    "b     | 22\n\n a  b\n  c\n\ntail & more end")
    assert [html_text.visible_text(x) for x in (None, "", "plain", "<p", "a<!-- b", "</b>x</p>")] == [
        "", "", "plain", "", "a", "x"]
    assert html_text.visible_text("<div>" * 5000 + "deep") == "deep"


def test_html_drawings_formulas_and_stray_quotes():
    shown = html_text.visible_text
    assert shown("<p>a <svg><title>no</title><desc>no</desc><defs/><rect/><g><text x=1>North</text><text>South "
                 "<tspan>pole</tspan></text></g><style/><metadata>no</metadata></svg> b") == "a North South pole b"
    assert shown("<p>so <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>no</annotation>"
                 "</semantics></math> holds<p>next") == "so x=2 holds\n\nnext"
    assert shown("<math/>after <desc>shown</desc><svg/> end") == "after shown end"
    assert shown("<p><a title=it's>Visible one</a> and don't stop</p>") == "Visible one and don't stop"
    assert shown("<p don't>one</p><p title='a>b' class = \"c>d\">two it's</p>") == "one\n\ntwo it's"
    assert shown("<a href=x?y=\"z>three</a> \"four\"> <b title=a'hidden>five</b>") == "three \"four\"> five"


def test_html_table_of_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a"), (1, "u", "<p>a"), (2, None, None)], "page_id long, url string, html string")
    assert sorted(map(tuple, html_text.extract(pages, ["page_id"]).collect())) == [(1, "a"), (1, "a"), (2, "")]
    assert html_text.extract(pages.where("false"), ["page_id"]).count() == 0


@pytest.mark.parametrize("page,text", [
    ("<html><head><title>T</title><body><p>Visible", "Visible"), ("<head><meta charset=utf-8><p>Visible two", "Visible two"),
    ("<head><style>x</style>bare text", "bare text"), ("<head><script>a</script> <link rel=x></head>one<p>two", "one\n\ntwo"),
    ("<html><body>a", "a"), ("<ul><li>a<li>b</ul>", "- a\n- b"), ("<dl><dt>a<dd>b<dt>c</dl>", "a\n  b\nc"),
    ("<p>a<div>b</div>", "a\n\nb"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a | b\nc"),
    ("<table><thead><tr><th>h<tbody><tr><td>x<tfoot><tr><td>f</table>", "h\nx\nf"),
    ("<select><option>a<option>b</select>", "a\nb")])
def test_html_with_tags_left_out(page, text):
    assert html_text.visible_text(page) == text


def test_html_spans_stay_aligned():
    shown = html_text.visible_text
    assert shown("<table><tr><td rowspan=2>A<td>B<tr><td>C<tr><td>D<td>E</table>") == "A | B\n  | C\nD | E"
    assert shown("<table><tr><td rowspan=0>A<td>B<tr><td>C<tbody><tr><td>D</table>") == "A | B\n  | C\nD"
    wide = shown("<table><tr><td colspan=70>A<td>Z<tr>" + "<td>b" * 70 + "<td>Y</table>").split("\n")
    assert wide[0].index("Z") == wide[1].index("Y")


def test_html_hidden_stays_hidden_at_any_depth():
    shown = html_text.visible_text
    for deep in (390, 405, 5000):
        assert shown("<div>" * deep + "<div hidden>SECRET</div>open" + "</div>" * deep + "after") == "open\nafter"
        assert shown("<span>" * deep + "<ul><li>x<li>y</ul>" + "</span>" * deep + "<p>after") == "- x\n- y\n\nafter"
    assert shown("<table><tr><td>" * 3000 + "<b style='display:none'>SECRET</b>in") == "in"
    assert shown("<div>" * 100_000 + "x").strip() == "x"


def test_html_style_is_read_by_declaration():
    shown = html_text.visible_text
    assert shown("<b style='--x-display:none'>a</b><b style='content: \"display:none\"'>b</b>") == "ab"
    assert shown("<b style='color:red; DISPLAY : None !important'>a</b><b style='visibility:collapse'>b</b>c") == "c"
    assert shown("<b style='display:none;display:inline'>a</b><b style='/* x */display:none'>b</b>") == "a"


def test_html_words_of_given_pages_equal_a_plain_parser():
    import pyarrow.parquet as pq
    from html.parser import HTMLParser

    class Plain(HTMLParser):
        """Text outside of elements that are not shown, in order."""
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.open = [], []

        def handle_starttag(self, tag, attrs):
            a = dict(attrs)
            style = (a.get("style") or "").replace(" ", "")
            hides = tag in html_text._UNSEEN or "hidden" in a or "display:none" in style or "visibility:hidden" in style
            if tag not in html_text._VOID:
                self.open.append((tag, hides))

        def handle_endtag(self, tag):
            if any(t == tag for t, _ in self.open):
                while self.open.pop()[0] != tag:
                    pass

        def handle_data(self, data):
            if not any(h for _, h in self.open):
                self.out.append(data)

    pages = pq.read_table("/root/testdata/sf0.001/pages.parquet").to_pylist()
    for row in pages:
        p = Plain()
        p.feed(row["html"] or "")
        p.close()
        assert re.findall(r"[^\W\d_]{2,}", html_text.visible_text(row["html"])) == re.findall(r"[^\W\d_]{2,}", " ".join(p.out)), row["page_id"]


def test_resharding_hash_does_not_overflow(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")).repartition(40)
    # places near the largest id: an addition would overflow for half of the hashes
    got = resharding.reshard(resharding.sized(rows), F.pmod("doc_id", F.lit(2)), 2, resharding.equal_capacities(3))
    assert got.count() == 20_000
    h = spark.range(1000).select(F.xxhash64(F.col("id"), F.lit(2**63 - 1)).alias("h"))
    assert h.where("h is null").isEmpty()


def test_quality_of_documents_with_columns_named_like_results(spark):
    texts = ["one two three " * 30, "alpha beta gamma delta " * 3, None]
    plain = frame(spark, texts)
    clash = plain.select("*", F.lit(7).alias("n_words"), F.lit("x").alias("word_chars"), F.lit(True).alias("kept"), F.lit(1).alias("_q_lines"),
                         F.lit(1).alias("N_Symbols"))
    want = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.kept) for r in quality.metrics(plain).collect()}
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.kept) for r in quality.metrics(clash).collect()} == want
    assert quality.kept_rows(clash).columns == clash.columns
    with pytest.raises(ValueError):
        quality.metrics(plain.select("doc_id", F.col("text").alias("kept")), text_col="kept")

"""The corpus operators against SQL, libraries and brute force, and on awkward tables."""

import collections
import hashlib
import math
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import queries as Q
from eventloom.llm.common import release, written
from eventloom.llm.components import components
from eventloom.llm.decontaminate import Index, find_leaks, question_answer
from eventloom.llm.language import held_out, identify, train, trigram_counts
from eventloom.llm.line_dedup import dedup_lines
from eventloom.llm.matroska import EBML_LACING, FIXED, XIPH, elements, lace, packets, padded, parse, read_payload, store_texts, vint, write_pcm
from eventloom.llm.near_dedup import estimate, near_duplicates, shingle_set, sketch
from eventloom.llm.piece_bpe import PieceBpe, encode_decode, merge_loop
from eventloom.llm.pieces import PieceCache
from eventloom.llm.pseudonyms import KINDS, SHAPES, pseudonymize
from eventloom.llm.revisits import canonical_url, resolve_revisits
from eventloom.llm.substring_dedup import anchors, interior, recompress, remove_repeats, word_hashes
from eventloom.llm.token_store import Shard, WordEncoder, read_tokens, write_shard, write_tokens

SF = "/root/testdata/sf0.001"
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i * 7919 % 4001}" for i in range(30_000))
AWKWARD = [(1, None), (2, ""), (3, " \t\n\r "), (4, "a"), (5, "a b"), (5, "a b"), (None, "a b"), (None, None), (6, LONG), (7, LONG), (8, "ÀB\n日本 😀\n"), (9, "x" * 20_000)]


def docs_of(con=None):
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, "doc_id bigint, text string")


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string")


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{t}'")
    df = Q.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    ours = sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())
    assert ours == sorted(map(repr, con.execute(f"SELECT {', '.join(cols)} FROM ({Q.ORACLES[name]})").fetchall()))


# 1: lines


def test_lines_awkward(spark, awkward, nothing):
    wide = awkward.selectExpr("doc_id", "text", "'z' n_lines", "1 n_dropped", "2 count")
    out = dedup_lines(wide, min_docs=3)
    assert out.columns == ["doc_id", "count", "text", "n_lines", "n_dropped"] and out.count() == len(AWKWARD)
    got = collections.Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect())
    assert got[(5, "", 1, 1)] == 2 and got[(None, "", 1, 1)] == 1  # "a b" stands in three rows
    assert got[(4, "a", 1, 0)] == 1 and got[(1, "", 1, 0)] == 1 and got[(8, "ÀB\n日本 😀\n", 3, 0)] == 1
    assert dedup_lines(nothing).count() == 0


def test_lines_keys(spark):
    rows = [(i, "A line\n own %d" % i) for i in range(3)] + [(9, " a LINE\t\nÉ\né"), (10, "\n\n")]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), min_docs=4).collect()}
    assert got == {0: " own 0", 1: " own 1", 2: " own 2", 9: "É\né", 10: "\n\n"}


# 2: tokens


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(Q.tokenizer_path("byte_bpe_50k.json"))


def test_words_encode_as_whole_texts(tokenizer):
    r, e = random.Random(2), WordEncoder(Q.tokenizer_path("byte_bpe_50k.json"))
    parts = ["a", "the", " ", "  ", "\n", " \n", "\t", "é", "1", "!", "'s", " '", ".", " ", "　", "日", "\x1c", "\u0085", "​"]
    for _ in range(4000):
        s = "".join(r.choice(parts) for _ in range(r.randint(0, 25)))
        assert np.frombuffer(e.encode(s), "<u4").tolist() == tokenizer.encode(s, add_special_tokens=False).ids, repr(s)


def test_added_tokens_as_the_library(spark, tokenizer):
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    assert "<|endoftext|>" in added
    r, e = random.Random(4), WordEncoder(Q.tokenizer_path("byte_bpe_50k.json"))
    parts = [*added, "<|endoftext", "|>", "a", " ", "  ", "\n", "é", "the"]
    texts = ["a <|endoftext|> b", *("".join(r.choices(parts, k=r.randrange(1, 12))) for _ in range(2000))]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(e.encode(t), "<u4").tolist() for t in texts] == want
    stored = read_tokens(write_tokens(spark.createDataFrame([(0, texts[0]), (1, "c d")], "doc_id bigint, text string"), Q.tokenizer_path("byte_bpe_50k.json"), 2)).collect()
    assert np.frombuffer(next(x.ids for x in stored if x.doc_id == 0), "<u4").tolist() == [*want[0], 2] == [64, 220, 50256, 275, 2]
    assert next(x.start for x in stored if x.doc_id == 1) == 5


@pytest.mark.parametrize("bits", [False, True])
def test_shards(bits):
    r = random.Random(1)
    lists = [np.array([r.randrange(1 << r.choice([4, 16, 32])) for _ in range(r.choice([0, 1, 5, 300, 1000]))], dtype="<u4") for _ in range(60)]
    shard = Shard(write_shard(lists, block_ids=128, bits=bits))
    assert all(np.array_equal(a, b) for a, b in zip(lists, shard.documents(), strict=True))
    whole = np.concatenate(lists)
    for _ in range(50):
        a = r.randrange(len(whole))
        b = r.randrange(a, len(whole) + 1)
        assert np.array_equal(shard.read(a, b), whole[a:b])
    assert list(Shard(write_shard([])).documents()) == []
    with pytest.raises(ValueError):
        Shard(b"\0" * 100)


def test_tokens(spark, tokenizer):
    rows = {r.doc_id: r for r in Q.op2_token_store(spark, SF).collect()}
    start = 0
    for i, text, _ in docs_of():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_tokens_awkward(spark, awkward, nothing):
    out = read_tokens(write_tokens(awkward.withColumn("start", awkward.doc_id), Q.tokenizer_path("byte_bpe_50k.json"), 2, shard_ids=100)).collect()
    assert len(out) == len(AWKWARD)
    ordered = sorted(out, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((i for i, _ in AWKWARD), key=lambda i: (i is not None, i))
    assert all(b.start - a.start == len(a.ids) // 4 for a, b in zip(ordered, ordered[1:]))
    assert read_tokens(write_tokens(nothing, Q.tokenizer_path("byte_bpe_50k.json"), 2)).count() == 0


# 3: revisits


def test_canonical_urls(spark):
    rows = [("HTTP://www.X.org:80/a/?utm_source=f&b=2&a=1#top", "x.org/a?a=1&b=2"), ("https://x.org/a?a=1&ref=x&b=2", "x.org/a?a=1&b=2"), ("http://x.org", "x.org"), (None, None)]
    df = spark.createDataFrame(rows, "u string, e string")
    assert all(r.c == r.e for r in df.select("e", canonical_url(df.u).alias("c")).collect())


def test_revisits(spark):
    h = lambda **k: [{"name": n.replace("_", "-"), "value": v} for n, v in k.items()]
    rows = [
        (1, "response", "http://x/a", 10, 200, "e1", None, h(etag="e1", content_type="t", date="10")),
        (2, "response", "http://x/a", 20, 200, "W/e2", None, h(date="20", content_length="5")),
        (3, "response", "http://x/a", 25, 404, "e3", None, None),
        (4, "revisit", "https://x/a#f", 30, 304, "e2", None, h(date="30", content_length="0", age="1")),
        (5, "revisit", "http://x/a", 15, 304, "e9", None, None), (6, "revisit", "http://x/a", 10, 304, "e1", None, None),
        (7, "revisit", None, 30, 304, "e2", None, None), (8, "response", "http://x/b", 5, 200, None, "mon", None),
        (9, "revisit", "http://x/b", 6, 304, "e", "mon", None), (10, "revisit", "http://x/b", 6, 304, "e", None, None), (11, "revisit", "http://x/a", None, 304, "e2", None, None),
    ]
    df = spark.createDataFrame(rows, "record_id bigint, kind string, url string, ts bigint, status int, etag string, last_modified string, headers array<struct<name: string, value: string>>")
    got = {r.record_id: r for r in resolve_revisits(df.selectExpr("*", "1 part", "2 target_id")).collect()}
    assert {i: (r.outcome, r.target_id) for i, r in got.items()} == {
        4: ("resolved", 2), 5: ("changed", 1), 6: ("none", None), 7: ("none", None), 9: ("resolved", 8), 10: ("unchecked", 8), 11: ("none", None),
    }
    assert {x["name"]: x["value"] for x in got[4].headers} == {"content-length": "5", "date": "30", "age": "1"} and got[5].headers is None
    assert resolve_revisits(df.limit(0)).count() == 0


def test_repeated_and_nameless_records(spark):
    """Each revisit row gives one row, whatever ids and rows repeat."""
    rows = [(1, "response", "http://x/a", 10, 200, "e1", None, None)] * 2 + [(2, "revisit", "http://x/a", 20, 304, "e1", None, None)] * 2
    rows += [(None, "revisit", "http://x/a", 30, 304, "e1", None, None), (2, "revisit", "http://x/a", 5, 304, "e1", None, None), (None, "response", "http://x/c", 1, 200, "e", None, None), (9, "revisit", "http://x/c", 2, 304, "e", None, None)]
    df = spark.createDataFrame(rows, "record_id bigint, kind string, url string, ts bigint, status int, etag string, last_modified string, headers array<struct<name: string, value: string>>")
    got = collections.Counter((r.record_id, r.outcome, r.target_id) for r in resolve_revisits(df.selectExpr("*", "1 URL2", "2 Part")).collect())
    assert got == {(2, "resolved", 1): 2, (None, "resolved", 1): 1, (2, "none", None): 1, (9, "resolved", None): 1}


def test_revisit_records_hold_all_cases(spark):
    rows = Q.op3_revisits(spark, SF).groupBy("outcome").count().collect()
    assert {r.outcome for r in rows} == {"resolved", "changed", "none", "unchecked"} and all(r["count"] >= 5 for r in rows)


def test_revisits_of_one_url(spark):
    """A hot URL spreads over many ranges; each revisit still finds the last response before it."""
    r = random.Random(3)
    rows = [(i, r.choice(["response", "revisit"]), "http://hot/", r.randrange(400), 200, "e", None, None) for i in range(1500)]
    df = spark.createDataFrame(rows, "record_id bigint, kind string, url string, ts bigint, status int, etag string, last_modified string, headers array<struct<name: string, value: string>>")
    full = [(t, i) for i, k, _, t, *_ in rows if k == "response"]
    want = {i: max((x for x in full if x[0] < t), default=(0, None))[1] for i, k, _, t, *_ in rows if k == "revisit"}
    assert {x.record_id: x.target_id for x in resolve_revisits(df).collect()} == want


# 4: near duplicates


def brute_components(rows, size, lower=True):
    sets = {}
    for i, text in rows:
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = SPLIT.findall(t)
        sets[i] = ({tuple(w[j : j + size]) for j in range(len(w) - size + 1)} or {tuple(w)}) if w else set()
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            k = len(sets[a] & sets[b])
            if k and 100 * k >= 80 * (len(sets[a]) + len(sets[b]) - k):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, size):
    rows = [(i, t) for i, t, _ in docs_of()]
    r = random.Random(4)
    base = [f"b{r.randrange(500)}" for _ in range(120)]
    for i in range(90):  # a family whose members drift apart, some of them out of reach
        w = list(base)
        for _ in range(r.randrange(22)):
            w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
        rows.append((10_000 + i, " ".join(w)))
    rows += [(20_000 + i, f"short text {i % 3}") for i in range(9)] + [(30_000, "one"), (30_001, "ONE"), (30_002, None), (30_003, " \n")]
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), size=size).collect()}
    assert got == brute_components(rows, size)


def test_near_duplicates_awkward(spark, awkward, nothing):
    out = near_duplicates(awkward.selectExpr("*", "1 id", "2 n", "3 key"), size=2).collect()
    assert len(out) == len(AWKWARD)
    got = collections.Counter((r.doc_id, r.component_id, r.kept) for r in out)
    assert got[(7, 6, False)] == 1 and got[(5, 5, True)] == 2 and got[(1, 1, True)] == 1 and got[(None, None, True)] == 2
    assert near_duplicates(nothing).count() == 0


def test_estimates():
    r = np.random.default_rng(5)
    off = []
    for n in (60, 500, 5000):
        for share in (0.0, 0.3, 0.8, 0.95):
            pool = r.integers(0, 2**63, 2 * n, dtype=np.uint64)
            k = round(2 * n * share / (1 + share))
            a, b = pool[:n], np.concatenate([pool[:k], pool[n : 2 * n - k]])
            j = k / (2 * n - k)
            off.append(estimate(sketch(np.unique(a))[None], sketch(np.unique(b))[None], np.array([n]), np.array([n]))[0] - j)
    assert max(map(abs, off)) < 0.2 and abs(np.mean(off)) < 0.05


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 3), (9, 8), (8, 9), *((i, i + 1) for i in range(100, 140)), *((50, i) for i in range(51, 70))]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, **{i: 100 for i in range(100, 141)}, **{i: 50 for i in range(50, 70)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# 5: languages


def test_language_accuracy(spark):
    truth = {i: g for i, _, g in docs_of()}
    rows = Q.op5_language(spark, SF).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(truth[r.doc_id] == r.lang_pred for r in out) >= 0.97 * len(out)


def naive_language(model, text):
    """The whole inference in plain Python: counts, mixture, penalised choice of the set."""
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0
    counts = {i: int(n) for i, n in enumerate(trigram_counts(text)) if n}
    p = [{i: float(row[i]) for i in counts} for row in model.likelihood]
    total = sum(counts.values())

    def fit(chosen):
        shares = [1 / len(chosen)] * len(chosen)
        for _ in range(30):
            new = [0.0] * len(chosen)
            for i, n in counts.items():
                mixed = sum(s * p[g][i] for s, g in zip(shares, chosen))
                for k, g in enumerate(chosen):
                    new[k] += n * shares[k] * p[g][i] / mixed / total
            moved = max(abs(a - b) for a, b in zip(new, shares))
            shares = new
            if moved < 1e-4:
                break
        return shares, sum(n * math.log(sum(s * p[g][i] for s, g in zip(shares, chosen))) for i, n in counts.items())

    penalty, everyone = 0.5 * math.log(max(total, 2)), list(range(len(p)))
    single = [sum(n * math.log(p[g][i]) for i, n in counts.items()) for g in everyone]
    best = (max(single) - penalty, [single.index(max(single))], [1.0])
    shares, _ = fit(everyone)
    order = sorted(everyone, key=lambda g: -shares[g])
    for k in range(2, len(p) + 1):
        chosen = sorted(order[:k])
        own, value = fit(chosen)
        if value - k * penalty > best[0]:
            best = (value - k * penalty, chosen, own)
    return model.languages[best[1][best[2].index(max(best[2]))]], max(best[2])


def test_language_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = train(docs.where(~held_out(docs.doc_id)))
    text = {i: t for i, t, _ in docs_of()}
    rows = Q.op5_language(spark, SF).collect()
    short = [r for r in rows if len(text[r.doc_id]) < 6000]
    assert len(short) > 100
    for r in short:
        lang, score = naive_language(model, text[r.doc_id])
        assert r.lang_pred == lang and abs(r.score - score) < 1e-4, r.doc_id


def test_mixtures(spark):
    rows = docs_of()
    model = train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    en, fr = (" ".join(t for _, t, g in rows if g == lang)[:4000] for lang in ("en", "fr"))
    mixed = spark.createDataFrame([(en + " " + fr,), (en,), (None,), ("12 34 !",), ("",)], "text string")
    a, b, *rest = identify(mixed.selectExpr("text", "1 score", "'q' languages"), model).collect()
    assert set(a.languages) == {"en", "fr"} and 0.35 < a.score < 0.65 and math.isclose(sum(a.shares), 1, abs_tol=1e-3)
    assert b.languages == ["en"] and b.score == 1
    assert all((r.lang_pred, r.score, r.languages) == ("und", 0, []) for r in rest)


def test_language_without_labels(spark, awkward, nothing):
    empty = train(nothing)
    assert empty.languages == [] and {r.lang_pred for r in identify(awkward, empty).collect()} == {"und"}
    assert identify(nothing, empty).count() == 0
    assert nothing.where(held_out(nothing.doc_id)).count() == 0


# 6: Matroska


def test_media(spark):
    rows = {r.doc_id: r for r in Q.op6_matroska(spark, SF).collect()}
    for i, text, _ in docs_of():
        raw = text.encode()
        whole = raw + bytes(-len(raw) % 64 if raw else 64)
        r = rows[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(whole), hashlib.sha256(whole).hexdigest(), zlib.crc32(whole[-64:]))
        assert "cues=true" in r.feature


def test_media_features_come_from_packets(spark):
    """Counts, times and byte ranges of the packet table agree with what the query says."""
    by = collections.defaultdict(list)
    for r in Q.media_packets(spark, SF).collect():
        by[r.doc_id].append(r)
    for r in Q.op6_matroska(spark, SF).collect():
        own = sorted(by[r.doc_id], key=lambda p: p.packet)
        feature = dict(x.split("=") for x in r.feature.split(";"))
        n = sum(p.size for p in own)
        assert (len(own), len({p.cluster for p in own}), n) == (int(feature["packets"]), int(feature["clusters"]), r.payload_bytes)
        assert int(feature["ns"]) == n * 125_000 and feature["cues"] == "true"
        assert int(feature["table"]) == zlib.crc32("\n".join(f"{p.track} {p.timestamp_ns} {p.start} {p.size}" for p in own).encode())
        assert all(a.start + a.size <= b.start for a, b in zip(own, own[1:]))


def test_media_awkward(spark, awkward, nothing):
    back = read_payload(store_texts(awkward.selectExpr("*", "1 media", "'p' payload"), drop_text=True)).collect()
    texts = collections.Counter((i, padded(t)[0]) for i, t in AWKWARD)
    assert collections.Counter((r.doc_id, bytes(r.payload)) for r in back) == texts
    assert read_payload(store_texts(nothing)).count() == 0
    broken = spark.createDataFrame([(b"\x1a\x45",), (None,), (b"",)], "media binary")
    assert all(r.payload is None and r.n_packets == 0 for r in read_payload(broken).collect()) and packets(broken).count() == 0


@pytest.mark.parametrize("lacing", [XIPH, FIXED, EBML_LACING])
def test_lacing(lacing):
    from eventloom.llm import matroska as M

    r = random.Random(lacing)
    frames = [bytes([i]) * (300 if lacing == FIXED else r.randrange(1, 900)) for i in range(9)]
    group = M.element(M.BLOCK_GROUP, M.element(M.BLOCK, b"\x81\x00\x07" + bytes([lacing << 1]) + lace(frames, lacing)) + M.element(M.REFERENCE_BLOCK, 1))
    unknown = M.CLUSTER.to_bytes(4, "big") + b"\xff" + M.element(M.TIMESTAMP, 5) + group
    data = M._HEADER + M.SEGMENT.to_bytes(4, "big") + b"\x01" + b"\xff" * 7 + M._INFO + unknown + M.element(M.CUES, b"")
    got = parse(data)
    assert [data[p.start : p.start + p.size] for p in got.packets] == frames
    assert all(p.timestamp == 12 * 125_000 and not p.keyframe and p.lacing == lacing for p in got.packets)


def test_packet_table(spark):
    data = write_pcm(bytes(range(256)) * 200)
    rows = packets(spark.createDataFrame([(1, data)], "id int, media binary")).orderBy("packet").collect()
    assert b"".join(data[r.start : r.start + r.size] for r in rows) == bytes(range(256)) * 200
    assert [r.timestamp_ns for r in rows] == sorted(r.timestamp_ns for r in rows) and rows[-1].cluster > 0
    assert vint(126) == b"\xfe" and vint(127) == b"\x40\x7f" and len(list(elements(data, 0, len(data)))) == 2


# 7: repeats


def brute_repeats(rows, window):
    words = [(i, SPLIT.findall(t or "")) for i, t in rows]
    seen = collections.Counter(tuple(w[j : j + window]) for _, w in words for j in range(len(w) - window + 1))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if seen[tuple(w[j : j + window])] > 1:
                gone[j : j + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return collections.Counter(out)


def repeats(df, window=35):
    return collections.Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in remove_repeats(df, window).collect())


def test_repeats(spark):
    rows = [(i, t) for i, t, _ in docs_of()]
    r = random.Random(6)
    for i in range(60):  # stretches of one source, runs, short cycles, windows just long enough or not
        n = r.choice([34, 35, 36, 60])
        at = r.randrange(200)
        middle = {0: " ".join(f"s{k}" for k in range(at, at + n)), 1: "run " * n, 2: "one two " * n}[i % 3]
        rows.append((1000 + i, f"a{i} {middle} z{i}"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert repeats(df) == brute_repeats(rows, 35)


def test_repeats_awkward(spark, awkward, nothing):
    assert repeats(awkward.selectExpr("*", "1 k", "2 t", "3 names", "4 hits")) == brute_repeats(AWKWARD, 35)
    assert repeats(nothing) == {}
    with pytest.raises(ValueError):
        remove_repeats(awkward, window=20)


def test_word_hashes():
    r = random.Random(14)
    texts = ["", "a", " a", "b ", "ab", "a b", "日本 é", "\n\t", "x" * 300_000, "a b\x0bc\x0cd\re"] + ["".join(r.choices("ab \n\té", k=r.randrange(30))) for _ in range(500)]
    r.shuffle(texts)
    raw = [t.encode() for t in texts]
    at = np.cumsum([0, *map(len, raw)])
    h, of = word_hashes(np.frombuffer(b"".join(raw), np.uint8), at)
    by = {}
    for i, t in enumerate(texts):
        own = SPLIT.findall(t)
        assert len(own) == of[i + 1] - of[i]
        for w, x in zip(own, h[of[i] : of[i + 1]].tolist()):
            assert by.setdefault(w, x) == x
    assert len(set(by.values())) == len(by) > 100
    assert len(word_hashes(np.zeros(0, np.uint8), np.zeros(3, np.int64))[0]) == 0


def test_batches_of_texts_are_kept_apart():
    r = np.random.default_rng(15)
    texts = [r.integers(0, 3 if i % 3 else 2**62, r.integers(0, 90)).astype(np.uint64) for i in range(80)]
    at = np.cumsum([0, *map(len, texts)])
    name, first, ends = anchors(np.concatenate(texts), 35, at)
    own = [(i, n, at[i] + a, at[i] + b) for i, t in enumerate(texts) for n, a, b in zip(*anchors(t, 35))]
    assert sorted(zip((np.searchsorted(at, first, side="right") - 1).tolist(), name, first, ends)) == sorted(own)


def test_repeated_windows_share_an_anchor():
    r = np.random.default_rng(7)
    for trial in range(200):
        shared = r.integers(0, 50 if trial % 2 else 2**62, 35)
        a, b = (np.concatenate([r.integers(0, 2**62, r.integers(0, 40)), shared, r.integers(0, 2**62, r.integers(0, 40))]).astype(np.int64) for _ in "ab")
        assert set(anchors(a, 35)[0].tolist()) & set(anchors(b, 35)[0].tolist())
    assert interior(35) == 21


def named_whole(n):
    """Phrases of 8 words whose repetition is named by one symbol of 8 words."""
    out, r = [], np.random.default_rng(11)
    for _ in range(40000):
        phrase = r.integers(0, 2**62, 8)
        if np.diff(recompress(np.tile(phrase, 12))[1])[2:-2].min() == 8:
            out.append(phrase)
            if len(out) == n:
                return out
    raise AssertionError("too few phrases")


def test_cycles_of_one_symbol_share_an_anchor():
    r = np.random.default_rng(12)
    for phrase in named_whole(3):
        for n in range(35, 70):
            cycle, turn = np.tile(phrase, 10), n % 8
            a, b = (np.concatenate([r.integers(0, 2**62, 9), cycle[turn : turn + n], r.integers(0, 2**62, 9)]) for _ in "ab")
            assert set(anchors(a, 35)[0].tolist()) & set(anchors(b, 35)[0].tolist())
    for window in range(22, 50):
        for trial in range(30):
            shared = np.tile(r.integers(0, 2**62, r.integers(2, 12)), 30)[:window]
            a, b = (np.concatenate([r.integers(0, 2**62, r.integers(0, 9)), shared, r.integers(0, 2**62, r.integers(0, 9))]) for _ in "ab")
            assert set(anchors(a, window)[0].tolist()) & set(anchors(b, window)[0].tolist())


def test_repeated_lines_of_eight_words(spark):
    r = random.Random(13)
    vocabulary = [f"v{i}" for i in range(3000)]
    data = " ".join(vocabulary).encode()
    hashed = dict(zip(vocabulary, word_hashes(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0]))
    lines = []
    while len(lines) < 2:
        line = r.sample(vocabulary, 8)
        if np.diff(recompress(np.tile(np.array([hashed[w] for w in line]), 12))[1])[2:-2].min() == 8:
            lines.append(" ".join(line))
    rows = [(1, "\n".join(["x", *[lines[0]] * 12, "y"])), (2, f"a {(lines[1] + ' ') * 6}b"), (3, f"c d {(lines[1] + ' ') * 5}e")]
    assert repeats(spark.createDataFrame(rows, "doc_id bigint, text string")) == brute_repeats(rows, 35)


# 8: pieces


def test_pieces_equal_the_library():
    bpe, r = PieceBpe(Q.tokenizer_path("piece_bpe_32k.model")), random.Random(8)
    texts = ["", " ", "   ", "a", "  a", "a  ", "\n\n x\t\ty", "hello ▁▁world", "x" * 500, "日本語 テスト😀", "<s> </s> <unk> <0x0A>", " " * 40 + "b" + " " * 33]
    texts += ["".join(r.choice("abcdeT  \n▁é日0129<>.,thein") for _ in range(r.randint(1, 60))) for _ in range(3000)]
    texts += ["".join(r.choice(["the", "in", "g", "er", " ", "an", "tion", "  ", "ou", "s"]) for _ in range(r.randint(1, 30))) for _ in range(3000)]
    assert [bpe.encode(t) for t in texts] == bpe.processor.encode(texts, num_threads=1)
    assert merge_loop(list("aaa"), {"aa": 1.0}) == ["aa", "a"]


def test_pieces(spark, awkward, nothing):
    bpe = PieceBpe(Q.tokenizer_path("piece_bpe_32k.model"))
    for r in encode_decode(awkward.selectExpr("*", "1 ids", "2 `__el_other`"), bpe_path := Q.tokenizer_path("piece_bpe_32k.model")).collect():
        ids = bpe.processor.encode(r.text or "")
        assert r.ids == ids and r.decoded == bpe.processor.decode(ids)
    assert encode_decode(nothing, bpe_path).count() == 0
    rows = {r.doc_id: r for r in Q.op8_piece_bpe(spark, SF).collect()}
    for i, text, _ in docs_of():
        ids = bpe.processor.encode(text)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (rows[i].n_tokens, rows[i].ids_sha256, rows[i].decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(bpe.processor.decode(ids)))


def test_cache_forgets():
    calls = []
    cache = PieceCache(lambda ps: calls.extend(ps) or [p.encode().ljust(4)[:4] for p in ps], budget=2 * 3 * 185, longest=3)
    for _ in range(2):
        assert cache.join(["a", "b", "a", "c"]) == b"a   b   a   c   "
    assert cache.join(["d", "e", "f", "a"]) == b"d   e   f   a   "
    assert len(cache.new) + len(cache.old) <= 8 and len(calls) == len(set(calls))
    assert cache.join(["long"] * 2) == b"longlong" and "long" not in cache.new | cache.old


# 9: benchmark


def test_leaks(spark):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    rows = docs_of()
    want = {(d, i) for d, t, _ in rows for i, u in items if u in t}
    got = {(r.doc_id, r.item_id) for r in Q.op9_decontaminate(spark, SF).collect()}
    assert want <= got and len(got - want) <= 0.1 * len(got)


def test_every_item_within_a_document_is_found():
    """Whatever is glued to it: on the largest table, and on items with answers of one word and more."""
    big = "/root/testdata/sf0.1"
    items = duckdb.sql(f"SELECT item_id, text FROM '{big}/benchmark.parquet' ORDER BY 1").fetchall()
    pairs = duckdb.sql(f"SELECT d.doc_id, i.item_id, d.text FROM '{big}/documents.parquet' d JOIN '{big}/benchmark.parquet' i ON contains(d.text, i.text)").fetchall()
    index = Index(items)
    assert len(pairs) > 200 and [(d, i) for d, i, t in pairs if i not in {x["item_id"] for x in index.leaks(t)}] == []


def test_short_answers():
    question = " ".join(f"q{i * 31 % 97}" for i in range(30))
    items = [(n, f"{question} z{n}. " + " ".join(f"a{n}b{k}" for k in range(n)) + ".") for n in range(1, 8)]
    index = Index(items)
    found = lambda t, n: n in {x["item_id"] for x in index.leaks(t)}
    for n, text in items:
        answer = text[:-1].split(". ")[1].split()
        assert all(found(f"before%%%{text}{junk} after", n) for junk in ("", "%%%", "$$$next", "&&& "))
        assert found(text[:-1] + "glued", n)
        assert not found(f"{question} z{n}. " + "other words follow here and go on " * 3, n)
        for k in range(len(answer)) if n > 1 else ():
            assert found(f"{question} z{n}. " + " ".join("changed" if j == k else w for j, w in enumerate(answer)), n), (n, k)


def test_long_items_are_held_whole():
    word = lambda i: f"w{i * 7919 % 4001}"
    cases = [(n, m) for n in (55, 64, 120, 300) for m in (1, 10, 100)]
    items = [(k, " ".join(word(400 * k + i) for i in range(n)) + ". " + " ".join(f"a{k}x{i}" for i in range(m))) for k, (n, m) in enumerate(cases)]
    index = Index(items)
    found = lambda t: [x["item_id"] for x in index.leaks(t)]
    filler = " ".join(f"f{i}" for i in range(150))
    for k, text in items:
        question, answer = text.split(". ")
        assert found(f"{filler} {text} {filler}") == [k] and found(f"{filler} {text.replace(' ', ' %% ', 5)}") == [k]
        assert found(f"{filler} {question} {filler}") == [] and found(f"{filler} {answer} {filler}") == []
        assert found(f"{question} {filler} {filler} {filler} {filler} {answer}") == []
    assert found(items[5][1].split()[-1]) == []


def test_bounds_lose_nothing():
    r = random.Random(9)
    vocabulary = [f"v{i}" for i in range(300)]
    index = Index([(i, " ".join(r.choices(vocabulary, k=r.randrange(5, 50)))) for i in range(120)])
    for dense in (index.dense, None):
        index.dense = dense
        for _ in range(200):
            terms = np.unique(np.array([index.term[w] for w in r.choices(vocabulary, k=60) if w in index.term]))
            scores = np.zeros(len(index.parts))
            for t in terms:
                at = slice(index.start[t], index.start[t + 1])
                scores[index.item[at]] += index.impact[at]
            assert [i for i, _ in index.search(terms, 0.3)] == np.nonzero(scores >= 0.3 - 1e-9)[0].tolist()


def test_leaks_without_bounds_are_the_same(spark):
    """Every part is scored for every passage of every text: nothing that the bounds skip is a hit."""
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet' ORDER BY 1").fetchall()
    index = Index(items)

    def score_all(terms, threshold):
        scores = np.zeros(len(index.parts))
        for t in terms:
            at = slice(index.start[t], index.start[t + 1])
            scores[index.item[at]] += index.impact[at]
        return [(int(i), float(scores[i])) for i in np.nonzero(scores >= threshold - 1e-9)[0]]

    index.search, index.dense, index.most = score_all, None, np.full(len(index.most), 1.0)
    want = {(d, x["item_id"], round(x["score"], 6), round(x["question"], 6), round(x["answer"], 6)) for d, t, _ in docs_of() if t for x in index.leaks(t)}
    assert {tuple(r) for r in Q.op9_decontaminate(spark, SF).collect()} == want and want


def test_passes_change_nothing(spark, monkeypatch):
    from eventloom.llm import decontaminate as D

    r = random.Random(15)
    texts = [(i, " ".join(f"v{int(r.paretovariate(0.6)) % 400}" for _ in range(r.randrange(20, 90)))) for i in range(60)]
    items = spark.createDataFrame(texts, "item_id bigint, text string")
    docs = spark.createDataFrame([(i, t.rsplit(" ", len(t.split()) // 4)[0]) for i, t in texts], "doc_id bigint, text string").coalesce(2)
    rows = lambda: {(r.doc_id, *x) for r in find_leaks(docs, items, threshold=0.3).collect() for x in r.leaks}
    one = rows()
    monkeypatch.setattr(D, "INDEX_CHARS", items.selectExpr("sum(length(text)) n").first().n // 5)
    many = rows()
    short = lambda found: {(d, i, round(s, 9), q, a) for d, i, s, q, a in found}
    assert len(one) > 0 and short(many) == short(one)


def test_leaks_awkward(spark, awkward, nothing):
    long_item = " ".join(f"w{i * 7919 % 4001}" for i in range(400, 700))
    items = spark.createDataFrame([(1, long_item), (2, None), (3, ""), (4, "zz yy xx. Ww vv uu!")], "item_id bigint, text string")
    found = {r.doc_id: [x.item_id for x in r.leaks] for r in find_leaks(awkward.selectExpr("*", "1 leaks"), items).collect()}
    assert found[6] == found[7] == [1] and not any(v for k, v in found.items() if k not in (6, 7))
    assert find_leaks(nothing, items).count() == 0 and not any(r.leaks for r in find_leaks(awkward, items.limit(0)).collect())
    assert question_answer("Why so? Since it is.") == (["why", "so"], ["since", "it", "is"]) and question_answer("one") == (["one"], [])


# 10: pseudonyms


def luhn(d):
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def test_pseudonyms(spark):
    rows = [
        "call (988) 555-2485 or card 4041894974608795, 4111 1111 1111 1111 not 4111 1111 1111 1112", "ip 70.123.182.155 999.1.1.1 on 2024-02-29 2023-02-29", None, "",
        "bosbt.42@mail8.example.com averyveryveryverylongname.of.mail.1234567@x.org 123-45-6789 000-12-1234", "again 4041-8949-7460-8795 and (988) 555-2485",
    ]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    out = pseudonymize(df.selectExpr("*", "1 found"), "key")
    got = {r.doc_id: r for r in out.collect()}
    a, b = got[0].found, got[5].found
    assert [x.kind for x in a] == ["phone", "card", "card"] and "4111 1111 1111 1112" in got[0].text and got[2].text is None and got[3].text == ""
    assert b[0].pseudonym.replace("-", "") == a[1].pseudonym and b[1].pseudonym == a[0].pseudonym  # linked across documents and spellings
    assert all(luhn(re.sub(r"\D", "", x.pseudonym)) for x in a[1:]) and re.fullmatch(r"\([2-9]\d\d\) [2-9]\d\d-\d{4}", a[0].pseudonym)
    assert [x.kind for x in got[1].found] == ["ip", "date"] and "999.1.1.1" in got[1].text and "2023-02-29" in got[1].text
    assert [x.kind for x in got[4].found] == ["email", "email", "ssn"] and "@mail8.example.com" in got[4].text
    back = {r.doc_id: r.text for r in pseudonymize(out.select("doc_id", "text"), "key", restore=True).collect()}
    assert back == dict(enumerate(rows))
    assert {r.doc_id: r.text for r in pseudonymize(df, "other").collect()}[0] != got[0].text


def test_phones_of_all_codes(spark):
    big = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").where("text rlike '[(][0-9]{3}[)] [0-9]{3}-[0-9]{4}'")
    plain = re.compile(r"\([0-9]{3}\) [0-9]{3}-[0-9]{4}")
    rows = [(r.doc_id, r.text) for r in big.collect()]
    extra = ["+1 (017) 555-5036", "+1 017-155-5036", "+1-988-555-2485", "+1 988 055 2485", "(988)555 2485", "call 988 555 2485.", "+1.200.199.0000", "+1 (199) 999-9999", "+1 (999) 199-9999", "(000) 000-0000"]
    rows += [(-i - 1, t) for i, t in enumerate(extra)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = pseudonymize(df, "key").cache()
    got = {r.doc_id: [x.value for x in r.found if x.kind == "phone"] for r in out.collect()}
    want = {i: plain.findall(t) for i, t in rows if i >= 0}
    assert sum(map(len, want.values())) == 159 and all(sorted(got[i]) == sorted(w) for i, w in want.items())
    assert all(len(got[-i - 1]) == 1 for i in range(len(extra)))
    assert {r.doc_id: r.text for r in pseudonymize(out.select("doc_id", "text"), "key", restore=True).collect()} == dict(rows)
    edges = [f"({a:03d}) {e:03d}-1234" for a in (0, 1, 199, 200, 201, 998, 999) for e in (0, 1, 198, 199, 200, 201, 999)]
    new = [r.text for r in pseudonymize(spark.createDataFrame([(t,) for t in edges], "text string"), "k").collect()]
    planned = lambda t: t[1] > "1" and t[6] > "1"
    assert len(set(new)) == len(edges) and all(plain.fullmatch(b) and planned(a) == planned(b) for a, b in zip(edges, new))
    numbers = ["017-555-5036", "1988 555 2485", "988 555 24856", "12 345 6789"]
    assert [r.text for r in pseudonymize(spark.createDataFrame([(t,) for t in numbers], "text string"), "k").collect()] == numbers


def test_pseudonyms_are_a_permutation(spark):
    """Different values stay different: all days of two years, and neighbouring numbers."""
    days = spark.range(731).select(F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).cast("string").alias("text"))
    ips = spark.range(1000).select(F.concat(F.lit("10.0.1."), (F.col("id") % 250).cast("string")).alias("text"))
    for df, n in ((days, 731), (ips, 250)):
        out = pseudonymize(df, "k")
        assert out.select("text").distinct().count() == n and out.where(F.size("found") == 1).count() == df.count()


def test_mail_names_that_look_like_other_kinds(spark):
    rows = ["4111111111111112@x.org", "2023-02-29@x.org and 2024-02-29@y.org", "1.2.3.4@x.org 1.2.3.4", "123-45-6789@x.org", "4111111111111111@a.b.com,4111111111111111"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    out = pseudonymize(df, "key")
    got = {r.doc_id: r for r in out.collect()}
    assert [[x.kind for x in got[i].found] for i in range(5)] == [["email"], ["email", "email"], ["email", "ip"], ["email"], ["email", "card"]]
    assert all(got[i].text != t and re.sub("[0-9]", "", got[i].text) == re.sub("[0-9]", "", t) for i, t in enumerate(rows))
    assert {r.doc_id: r.text for r in pseudonymize(out.select("doc_id", "text"), "key", restore=True).collect()} == dict(enumerate(rows))


class PlainPseudonyms:
    """The same permutations one value at a time, in plain Python."""

    def __init__(self, key):
        self.key = key
        shapes = {**SHAPES, "email": SHAPES["email"].replace("(?=@", "@(?=", 1)}
        self.any = re.compile("|".join(f"(?P<{k}>{p})" for k, p in shapes.items()))

    def keyed(self, *parts):
        return int(hashlib.sha256("|".join([self.key, *map(str, parts)]).encode()).hexdigest()[:15], 16)

    def feistel(self, kind, shape, l, r, a, b):
        for i in range(10):
            if i % 2 == 0:
                l = (l + self.keyed(i, kind, shape, r) % a) % a
            else:
                r = (r + self.keyed(i, kind, shape, l) % b) % b
        return l, r

    def refill(self, template, digits):
        it = iter(digits)
        return "".join(next(it) if c.isdigit() else c for c in template)

    def date(self, m):
        import datetime as dt

        try:
            day = (dt.date.fromisoformat(m) - dt.date(1900, 1, 1)).days
        except ValueError:
            return None
        l, r = self.feistel("date", "", day // 4297, day % 4297, 17, 4297)
        return (dt.date(1900, 1, 1) + dt.timedelta(l * 4297 + r)).isoformat()

    def ip(self, m):
        o = list(map(int, m.split(".")))
        l, r = self.feistel("ip", "", o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536)
        return f"{l // 256}.{l % 256}.{r // 256}.{r % 256}"

    def ssn(self, m):
        x, y, z = map(int, m.split("-"))
        l, r = self.feistel("ssn", "", x - 2 if x > 666 else x - 1, (y - 1) * 9999 + z - 1, 898, 99 * 9999)
        return f"{l + 2 if l >= 665 else l + 1:03d}-{r // 9999 + 1:02d}-{r % 9999 + 1:04d}"

    def phone(self, m):
        d = re.sub("[^0-9]", "", m)
        area, exch, line = int(d[:3]), int(d[3:6]), int(d[6:])
        if area >= 200 and exch >= 200:
            l, r = self.feistel("phone", "", (area - 200) * 800 + exch - 200, line, 640000, 10000)
            area, exch = l // 800 + 200, l % 800 + 200
        else:
            l, r = self.feistel("phone", "unplanned", area * 1000 + exch if area < 200 else 200000 + (area - 200) * 200 + exch, line, 360000, 10000)
            area, exch = divmod(l, 1000) if l < 200000 else ((l - 200000) // 200 + 200, (l - 200000) % 200)
        return self.refill(m, f"{area:03d}{exch:03d}{r:04d}")

    def card(self, m):
        d = re.sub("[^0-9]", "", m)
        if luhn(d) is False:
            return None
        n, nl = len(d), (len(d) - 2) // 2
        l, r = self.feistel("card", n, int(d[1 : 1 + nl]), int(d[1 + nl : n - 1]), 10**nl, 10 ** (n - 2 - nl))
        body = f"{d[0]}{l:0{nl}d}{r:0{n - 2 - nl}d}"
        return self.refill(m, next(body + str(c) for c in range(10) if luhn(body + str(c))))

    def email(self, m):
        m = m[:-1]
        base = lambda c: "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else None
        radix = lambda c: 26 if c.isalpha() else 10 if c.isdigit() else 1
        char = lambda c, v: chr(ord(base(c)) + v) if base(c) else c
        place = lambda c: ord(c) - ord(base(c)) if base(c) else 0
        nc = min(len(m), 24)
        half = -(-nc // 2)
        sides = m[:half], m[half:nc]
        value, span = [0, 0], [1, 1]
        for k, s in enumerate(sides):
            for c in s:
                value[k], span[k] = value[k] * radix(c) + place(c), span[k] * radix(c)
        l, r = self.feistel("email", re.sub("[0-9]", "9", re.sub("[a-zA-Z]", "a", m)), *value, *span)
        out = ""
        for s, v in zip(sides, (l, r)):
            part = ""
            for c in reversed(s):
                v, x = divmod(v, radix(c))
                part = char(c, x) + part
            out += part
        return out + "".join(char(c, (place(c) + self.keyed("rest", i, l, r) % radix(c)) % radix(c)) for i, c in enumerate(m[nc:])) + "@"

    def text(self, t):
        found = []

        def new(m):
            x = getattr(self, m.lastgroup)(m[0])
            if x is not None:
                found.append(f"{m.lastgroup}:{x.removesuffix('@')}")
            return m[0] if x is None else x

        out = self.any.sub(new, t)
        return out, "|".join(found)


def test_pseudonyms_against_plain_python(spark):
    plain = PlainPseudonyms(Q.TEST_KEY)
    rows = {r.doc_id: r for r in Q.op10_pseudonyms(spark, SF).collect()}
    kinds = collections.Counter()
    for i, t, _ in docs_of():
        text, found = plain.text(t)
        assert (rows[i].text, rows[i].pseudonyms) == (text, found), i
        kinds.update(x.split(":")[0] for x in found.split("|") if x)
        assert all(rows[i][f"n_{k}"] == sum(x.startswith(k + ":") for x in found.split("|")) for k in KINDS)
    assert len(kinds) >= 3
    extra = ["a.b_c-1@x.org ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789@y.org", "123-45-6789 899-01-0001 667-99-9999", "4111-1111-1111-1111 378282246310005 6011 0000 0000 0004", "1.2.3.4 255.255.255.255 2000-02-29 1900-01-01 2099-12-31", "+1 (017) 555-5036 (200) 200-0000 (999) 199-9999 212-555-0100"]
    out = pseudonymize(spark.createDataFrame(list(enumerate(extra)), "doc_id bigint, text string"), Q.TEST_KEY).collect()
    assert {r.doc_id: r.text for r in out} == {i: plain.text(t)[0] for i, t in enumerate(extra)}


CLASHING = ["Doc_ID", "TEXT", "N_Lines", "Score", "IDS", "Leaks", "Found", "Media", "__el_gone", "__el_text", "K"]


def test_names_that_differ_in_case_only(spark):
    """No extra column crashes an operator; results replace columns of their names, whatever the case."""
    rows = [(i, "one two three four\nfive") for i in range(12)]
    plain = spark.createDataFrame(rows, "doc_id bigint, text string")
    wide = plain.selectExpr("doc_id", "text", *(f"{i} as `{c}`" for i, c in enumerate(CLASHING))).toDF("doc_id", "text", *CLASHING)
    path, model = Q.tokenizer_path("piece_bpe_32k.model"), train(plain.selectExpr("text", "'en' lang"))
    results = {
        "n_lines": dedup_lines(wide), "score": identify(wide, model), "ids": encode_decode(wide, path), "leaks": find_leaks(wide, plain.selectExpr("doc_id item_id", "text")),
        "found": pseudonymize(wide, "k"), "media": store_texts(wide), "n_shingles": near_duplicates(wide), "n_removed": remove_repeats(wide, 35),
        "start": read_tokens(write_tokens(wide, Q.tokenizer_path("byte_bpe_50k.json"), 2)),
    }
    for name, df in results.items():
        names = [c.lower() for c in df.columns]
        assert len(df.collect()) == 12 and names.count(name) == 1, name
    assert [c for c in results["n_lines"].columns if c.lower() == "text"] == ["TEXT", "text"]


def test_pseudonyms_are_native(spark, awkward, nothing):
    out = pseudonymize(awkward, "k")
    assert not re.search("Python|Pandas|Arrow|Exchange", out._jdf.queryExecution().executedPlan().toString())
    assert collections.Counter((r.doc_id, r.text) for r in out.collect()) == collections.Counter(AWKWARD)
    assert pseudonymize(nothing, "k").count() == 0


# The pipeline


def test_pipeline(spark):
    import corpus_pipeline as P

    rows = [(i, t, "") for i, t, _ in docs_of()]
    rows = [(i, t) for i, t, _ in rows if re.search(r"[^\W\d_]", t)]
    key = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s).strip(" \t\n\x0b\x0c\r")
    seen = collections.Counter(k for _, t in rows for k in {key(s) for s in t.split("\n")})
    rows = [(i, "\n".join(s for s in t.split("\n") if not key(s) or seen[key(s)] < 10)) for i, t in rows]
    kept = brute_components(rows, 5)
    rows = [(i, t) for i, t in rows if kept[i][2]]
    index = Index(duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet' ORDER BY 1").fetchall())
    clean = [(i, t) for i, t in rows if not index.leaks(t)]
    bpe = PieceBpe(Q.tokenizer_path("piece_bpe_32k.model"))
    want = {i: hashlib.sha256(",".join(map(str, bpe.processor.encode(t))).encode()).hexdigest() for i, t in clean}
    before = set(written(spark))
    assert {r.doc_id: r.ids_sha256 for r in P.run(spark, SF).collect()} == want
    assert len(set(written(spark)) - before) == 1  # the table that the last stage reads; the others are gone
    release(spark, but=before)
    assert set(written(spark)) == before
    assert [n for n, _ in P.STAGES] == ["language", "lines", "near_duplicates", "benchmark", "pieces"]


def test_language_stage_without_labels(spark):
    import corpus_pipeline as P

    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 0)
    texts = [(held, "clean text"), (1001, "один"), (1002, "日本"), (1003, None), (1004, ""), (1005, "12 34 !_\n")]
    for label in (None, "en"):  # en: on the held-out row only
        rows = [(i, t, label if i == held else None) for i, t in texts]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
        assert sorted(r.doc_id for r in P.language_stage(spark, docs, SF).collect()) == sorted((held, 1001, 1002))


def test_pipeline_keeps_columns(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_pipeline_stages_awkward(spark):
    """Nulls, repeats, long and empty texts, clashing names and empty tables, through each stage on its own."""
    import corpus_pipeline as P

    rows = [(i, t, None if i == 3 else "en", None, n) for n, (i, t) in enumerate(AWKWARD)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumn("Doc", F.lit(1)).withColumn("Score", F.lit(2)).withColumn("N_Dropped", F.lit(3))
    docs = docs.select("*", F.lit(4).alias("LEAKS"), F.lit(5).alias("TEXT"), F.lit(6).alias("Doc_Id"))
    ids = lambda df: collections.Counter(r[0] for r in df.collect())
    every = collections.Counter(i for i, _ in AWKWARD)
    kept = {
        "language": collections.Counter({i: n for i, n in every.items() if i not in (1, 2, 3, None)}) + collections.Counter([None]),
        "lines": every, "near_duplicates": every - collections.Counter([7]), "benchmark": every, "pieces": every,
    }
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        assert ids(out) == kept[name], name
        assert name == "pieces" or out.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0, name

"""Prefix trie, secret scans and token alignment against brute force."""

import collections
import hashlib
import random
import re
import string
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from hourmeter.llm import alignment, prefix_trie, queries, secrets

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TURNS = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def in_order(rows):
    """Each conversation's (role, text) in the operator's order."""
    found = collections.defaultdict(list)
    for c, k, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            found[c].append(((k is not None, k or 0, role, digest), (role, text)))
    return {c: [t for _, t in sorted(x)] for c, x in found.items()}


def brute_trie(convs):
    members = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    below, out = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves = sum(below[x][0] for x in children[k]) or 1
        spared = sum(below[x][1] for x in children[k]) + (len(members[k]) - 1) * (len(WORD.findall(k[-1][1])) if k else 0)
        below[k] = leaves, spared
        ends = ",".join(map(str, sorted(c for c in members[k] if len(convs[c]) == len(k))))
        out[min(members[k]), len(k)] = (min(members[k[:-1]]) if k else None, len(members[k]), len(children[k]), leaves, spared, sha(ends))
    return out


def told_trie(df):
    rows = df.collect()
    out = {(r["conv_id"], r["depth"]): tuple(r)[2:] for r in rows}
    assert len(out) == len(rows)
    return out


def random_conversations(seed):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-50, 400), 60):
        n = rnd.choice([1, 1, 2, 3, 4, 5, 8, 9, 13, 30])
        rows += [(c, t, "ua"[t % 2], rnd.choice(["yes", "no way", ""]) if t > 2 else rnd.choice(["yes", "yes", "no"])) for t in range(n)]
    same = [(t, "u", f"turn {t} of it") for t in range(11)]
    rows += [(c, *x) for c in (500, 501, 502, 777) for x in same]
    rows += [(c, *x) for c in (503, 504) for x in same[:8]]  # end at a block's end
    rows += [(505, *x) for x in same[:9]] + [(505, 9, "u", "another way")]
    return rows


@pytest.mark.parametrize("size", [1, 4, 5])
def test_trie_matches_brute_force(spark, size):
    rows = random_conversations(size)
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    assert told_trie(prefix_trie.prefix_trie(spark, df, size)) == brute_trie(in_order(rows))


def test_trie_of_odd_rows(spark):
    rows = [(1, None, None, "first"), (1, None, "a", None), (1, 0, "u", "x  y"), (2, 5, "u", "x"), (2, 5, "u", "x"), (2, 5, "a", "x")]
    rows += [(None, 0, "u", "nobody's"), (3, 0, None, None), (4, 0, "", ""), (5, 0, "1:", "z"), (6, 0, "1", ":z")]
    df = spark.createDataFrame([(*r, 7, "extra") for r in rows], TURNS + ", pos long, digest string")
    assert told_trie(prefix_trie.prefix_trie(spark, df)) == brute_trie(in_order(rows))
    assert prefix_trie.prefix_trie(spark, df.limit(0)).count() == 0


def test_long_conversations_and_hot_copies_in_small_slices(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SLICE_TURNS", 7)
    monkeypatch.setattr(prefix_trie, "SLICE_BLOCKS", 3)
    monkeypatch.setattr(prefix_trie, "END_IDS", 10)
    long = [(t, "u", f"w{t % 5} of {t // 40}") for t in range(150)]
    rows = [(c, *x) for c in range(3) for x in long] + [(3, *x) for x in long[:100]] + [(3, 100, "u", "aside"), (3, 101, "u", "end")]
    rows += [(c, 0, "u", "one text of many") for c in range(10, 75)]
    df = spark.createDataFrame(rows, TURNS).repartition(4)
    assert told_trie(prefix_trie.prefix_trie(spark, df)) == brute_trie(in_order(rows))


def test_trie_query_rebuilds_conversations(spark, tmp_path):
    rows = random_conversations(11)
    spark.createDataFrame(rows, TURNS).write.parquet(str(tmp_path / "conversations.parquet"))
    own, rebuilt = in_order(rows), {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 4, c - int(np.fmod(c, 20))
        rebuilt[c] = own.get(base, [])[:h] + own[c][h:]
    assert any(not x for x in rebuilt.values())
    assert told_trie(queries.op13_prefix_trie(spark, str(tmp_path))) == brute_trie(rebuilt)


def brute_base(text):
    text, out = text or "", []
    for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return ",".join(f"{k}:{a}:{e}" for a, _, e, k in sorted(out))


@pytest.fixture(scope="module")
def secret_rows():
    rnd = random.Random(5)

    def key(n, alphabet):
        return "".join(rnd.choice(alphabet) for _ in range(n))

    b62 = string.ascii_letters + string.digits
    rows = [(1, None), (2, ""), (None, "token: abcdefgh"), (3, "password = \"abc\" secret: abcdef token=token:abcdef \U0001f600 API-KEY api_key:'Zz9+/_.=-x' apikey=  \"q1w2e3\" PASSWD:abcdef")]
    rows += [(4, "AKIA" + "A" * 15 + " AKIA" + "Z9" * 8 + "x AKIAAKIA" + "B" * 12), (5, "deadbeef" * 3 + " " + "0" * 23 + " " + "a1" * 50), (5, "deadbeef" * 3)]
    rows += [(6, " ".join(f"token={key(12, b62)}" for _ in range(1500))), (7, key(50_000, b62 + "+/")), (8, "x" * 200_000), (9, "paſſword=abcdefgh toKen=abcdefgh \u0000   secret\n=abcdefg")]
    keys = {}
    for i in range(40):
        keys[100 + i] = key(40, b62 + "+/")
        rows.append((100 + i, f"été {keys[100 + i]} and more"))
    for i in range(20):
        rows.append((200 + i, f"thequickbrownfox20240108jumpsover{'it' * i} OrdinaryWordsInCamelCase{i}andMoreOfThemAnd{'Then' * i}Some"))
    rows += [(300, "secret=" + keys[100]), (301, f"{keys[101]} secret={keys[102]} {keys[103]}")]
    return rows, keys


def test_secret_spans_match_brute_force_and_sql(spark, secret_rows, tmp_path):
    rows, keys = secret_rows
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12_secret_scan(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"] or 0, r["base_sha256"]) for r in got) == sorted((d or 0, sha(brute_base(t))) for d, t in rows)
    spans = {r["doc_id"]: r["spans"] for r in got}
    # a random key has a p below the least bound, or none of the digits, now and then
    found = [spans[d] == f"random:4:{4 + len(k)}" for d, k in keys.items()]
    assert sum(found) >= 38 and all(spans[d] in ("", f"random:4:{4 + len(k)}") for d, k in keys.items())
    assert all(not spans[200 + i] for i in range(20)) and not spans[8] and spans[7] == "random:0:50000"
    assert spans[300] == "assign:0:47"
    assert spans[301] == ",".join(s for s, ok in (("random:0:40", found[1]), ("assign:41:88", True), ("random:89:129", found[3])) if ok)
    documents = spark.read.parquet(str(tmp_path / "documents.parquet")).toArrow()  # noqa: F841 - the SQL reads it
    want = duckdb.sql(queries.OP12_SQL.replace("from documents", "from documents d"))
    names = [c for c in want.columns]
    assert sorted(map(str, want.fetchall())) == sorted(str(tuple(r[c] for c in names)) for r in got)


def test_randomness_p_values_are_uniform_for_random_keys(spark):
    rnd = random.Random(9)
    rows = []
    for name, alphabet, _ in secrets.ENCODINGS:
        for n in (20, 64):
            rows += [(name, n, "".join(rnd.choice(alphabet) for _ in range(n))) for _ in range(300)]
    df = spark.createDataFrame(rows, "name string, n int, key string")
    p = df.select("n", secrets.randomness(F.col("key"), F.col("name")).alias("p"))
    for r in p.groupBy("n").agg(F.avg((F.col("p") < 0.05).cast("int")).alias("low"), F.avg((F.col("p") > 0.5).cast("int")).alias("high")).collect():
        assert 0.02 < r["low"] < 0.09 and 0.42 < r["high"] < 0.58
    words = ["HelloWorldThisIsMyName1234567890", "abcdefghijklmnopqrstuvwxyz0123456789", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1", "20240108T060230thequickbrownfoxjumpsoverthelazydog"]
    told = spark.createDataFrame([(w,) for w in words], "key string").select("key", secrets.randomness(F.col("key"), secrets.encoding(F.col("key"))).alias("p")).collect()
    assert all(r["p"] < 0.05 for r in told)


def test_running_over_parts(spark, monkeypatch):
    monkeypatch.setattr(secrets, "_PART", 3)
    for n in (0, 1, 2, 3, 4, 9, 10, 31):
        df = spark.createDataFrame([(list(range(1, n + 1)),)], "x array<long>")
        assert df.select(secrets.running(F.col("x"), F.lit(0).cast("long"), lambda a, b: a + b)).first()[0] == [0, *np.cumsum(range(1, n + 1)).tolist()]


def test_secret_scan_of_odd_documents(spark, odd_documents):
    out = secrets.scan(spark, odd_documents)
    assert out.count() == odd_documents.count() and out.where("size(base) > 0").count() == 0
    assert secrets.scan(spark, odd_documents.limit(0)).count() == 0


@pytest.fixture(scope="module")
def files():
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute_alignment(text, files):
    import sentencepiece
    import tokenizers

    if files not in _LIBRARY:
        t = tokenizers.Tokenizer.from_file(files[0])
        t.encode_special_tokens = True
        _LIBRARY[files] = t, sentencepiece.SentencePieceProcessor(model_file=files[1])
    t, s = _LIBRARY[files]
    if not text:
        return None
    ids = t.encode(" " + text, add_special_tokens=False).ids, s.encode(text)
    byte = alignment.byte_of_character()
    tokens = [bytes(byte[c] for c in t.id_to_token(i)) for i in ids[0]], [bytes([int(s.id_to_piece(i)[3:5], 16)]) if s.is_byte(i) else s.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]
    if any(b"".join(x) != (" " + text).encode() for x in tokens):
        return None
    ends = [np.cumsum([len(x) for x in y]).tolist() for y in tokens]
    groups, i, j = [], 0, 0
    for c in sorted(set(ends[0]) & set(ends[1])):
        i2, j2 = ends[0].index(c, i) + 1, ends[1].index(c, j) + 1
        groups.append(",".join(map(str, ids[0][i:i2])) + "|" + ",".join(map(str, ids[1][j:j2])))
        i, j = i2, j2
    links, i, j = [], 0, 0
    while i < len(ids[0]) and j < len(ids[1]):
        links.append((ids[0][i], ids[1][j]))
        i, j = i + (ends[0][i] <= ends[1][j]), j + (ends[1][j] <= ends[0][i])
    return len(ids[0]), len(ids[1]), len(groups), links, sha(";".join(groups))


_LIBRARY = {}


def alignment_rows():
    rnd = random.Random(2)
    words = ["alignment", "tokenizers", "naïve", "Donaudampfschiff", "今天天气", "x1y2", "\U0001f600", "ßß", "don't", "  ", "\n\n", "\t", "3.14159", "<|endoftext|>", "<s>", "ไทย"]
    rows = [(k, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 40)))) for k in range(40)]
    rows += [(50, None), (51, ""), (52, " "), (53, "a▁b"), (54, "今天天气很好。" * 300), (55, "z" * 5000), (56, rows[3][1]), (56, rows[3][1]), (None, rows[4][1]), (57, "a\u0000b"), (58, "﻿bom"), (59, "é Ω Ａ")]
    return rows


@pytest.mark.parametrize("block_pairs", [1, 200, 2_000_000])
def test_alignment_matches_brute_force(spark, files, block_pairs):
    rows = alignment_rows()
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, pair int").repartition(3)
    out, pairs = alignment.align(spark, docs, *files, block_pairs=block_pairs)
    told = [brute_alignment(t, files) for _, t in rows]
    held = collections.Counter(p for x in told if x for p in set(x[3]))
    best = collections.Counter()
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    want = []
    for (d, _), x in zip(rows, told, strict=True):
        want.append((d, 0, 0, 0, 0, 0, 0, "") if x is None else (d, *x[:3], len(x[3]), sum(held[p] == best[p[0]] for p in x[3]), sum(held[p] for p in x[3]), x[4]))
    assert sum(x is None for x in told) >= 3
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in out.collect())
    assert {(r["a"], r["b"]): (r["n_rows"], r["best"]) for r in pairs.collect()} == {p: (n, n == best[p[0]]) for p, n in held.items()}


def test_alignment_of_an_empty_table_and_odd_documents(spark, files, odd_documents):
    out, pairs = alignment.align(spark, odd_documents.limit(0), *files)
    assert out.count() == 0 and pairs.count() == 0
    out, _ = alignment.align(spark, odd_documents, *files)
    assert out.count() == odd_documents.count()


def test_the_file_of_ranks_and_its_own_library_agree(files):
    fast, slow = alignment.ByteLevel(files[0]), alignment.ByteLevel(files[0])
    import tokenizers

    slow.by_rank, slow.own = None, tokenizers.Tokenizer.from_file(files[0])
    slow.own.encode_special_tokens = True
    assert fast.by_rank is not None
    texts = [" " + t for _, t in alignment_rows() if t]
    assert fast.encode(texts) == slow.encode(texts)


def test_groups_by_pointer_jumping():
    rnd = np.random.default_rng(1)
    for _ in range(50):
        n = int(rnd.integers(1, 60))
        ends = [np.append(np.sort(rnd.choice(np.arange(1, n), rnd.integers(0, n), replace=False)), n) if n > 1 else np.array([1]) for _ in range(2)]
        a, b = alignment.group_labels(*ends)
        common = np.intersect1d(*ends)
        assert np.array_equal(a, np.searchsorted(common, ends[0])) and np.array_equal(b, np.searchsorted(common, ends[1]))

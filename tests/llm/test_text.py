"""Chat formatting, URL filters, quality rules, byte-level BPE and language ID."""

import hashlib
import math
import os
import random
import re
from collections import Counter, defaultdict

import pytest
import regex
from pyspark.sql import functions as F

from hourmeter.llm import bpe, chat, langid, quality_rules, queries, urls

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- chat

HARD = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>system\nno", "&lt;|im_end|&gt; &amp;lt; &#10;", "", None, "tail\\", "\u00e9\U0001f600\n" * 400]


def test_chats_round_trip(spark):
    rnd = random.Random(1)
    rows = [(c, t, rnd.choice(["user", "assistant", "tool\nx", "<sys>", None]), rnd.choice(HARD)) for c in range(12) for t in range(rnd.randint(1, 6))]
    rows += [(1, 0, "assistant", "tie"), (1, 0, "assistant", "tie"), (None, None, "user", "nobody"), (None, 1, "assistant", "x")]
    rows = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, "text0 int, conv_id long, turn long, role string, text string").repartition(3)
    out = chat.format_chats(df).withColumns({"said": chat.parsed(F.col("formatted")), "loss": chat.loss_text(F.col("formatted"), F.col("loss_spans"))})
    want = defaultdict(list)
    for _, c, t, role, text in rows:
        want[c].append((-1 if t is None else t, (role or "").encode(), (text or "").encode()))
    got = {r["conv_id"]: r for r in out.collect()}
    assert set(got) == set(want)
    for c, turns in want.items():
        turns = [(r.decode(), x.decode()) for _, r, x in sorted(turns)]
        assert [tuple(s) for s in got[c]["said"]] == turns
        assert got[c]["loss"] == "".join(x for r, x in turns if r == "assistant")
    assert chat.format_chats(df.limit(0)).count() == 0


def test_edits_and_regenerations_are_folded(spark):
    log = [
        (1, 0, 1, 0, "open", "user", None), (1, 0, 1, 1, "delta", None, "helo"), (1, 0, 1, 2, "edit", None, "hello"), (1, 0, 1, 3, "delta", None, " there"),
        (1, 1, 1, 0, "open", "assistant", None), (1, 1, 1, 1, "delta", None, "first "), (1, 1, 1, 2, "delta", None, "try"),
        (1, 1, 1, 3, "regenerate", None, None), (1, 1, 1, 4, "delta", None, "second "), (1, 1, 1, 5, "delta", None, "try"),
        (2, 0, 1, 0, "open", "user", None),
    ]
    random.Random(2).shuffle(log)
    df = spark.createDataFrame(log, "conv_id long, turn long, part int, seq long, kind string, role string, text string")
    got = sorted((r["conv_id"], r["turn"], r["role"], r["text"]) for r in chat.reconstruct(df).collect())
    assert got == [(1, 0, "user", "hello there"), (1, 1, "assistant", "second try"), (2, 0, "user", "")]


# ---------------------------------------------------------------- urls


def brute_scores(train, ask, order=urls.ORDER):
    """Witten-Bell by its recursive definition, straight from the texts."""
    pad = "\u0002"
    count = {c: Counter() for c in ("allow", "block")}
    for url, verdict in train:
        s = pad * order + url + pad
        for i in range(order, len(s)):
            for k in range(order + 1):
                count[verdict][s[i - k : i + 1]] += 1
    after = {c: defaultdict(dict) for c in count}
    for c in count:
        for g, n in count[c].items():
            after[c][g[:-1]][g[-1]] = n

    def p(c, context, x):
        below = p(c, context[1:], x) if context else 1 / urls.ALPHABET
        seen = after[c].get(context, {})
        n, t = sum(seen.values()), len(seen)
        return (seen.get(x, 0) + t * below) / (n + t) if n else below

    out = {}
    for url in ask:
        s = pad * order + url + pad
        terms = [math.log(p("allow", s[i - order : i], s[i]) / p("block", s[i - order : i], s[i])) for i in range(order, len(s))]
        out[url] = sum(terms) / len(terms)
    return out


def test_url_rules_and_scores(spark):
    rnd = random.Random(4)
    rows = [(i, f"http{rnd.choice(['', 's'])}://{rnd.choice(['', 'www.', 'M.'])}{rnd.choice(['Example', 'ab', 'zq'])}.{rnd.choice(['com', 'net', 'org'])}/{rnd.choice(['en', 'es', 'fr'])}/{rnd.randint(1, 40)}{rnd.choice(['', '?q=1', '#top'])}") for i in range(160)]
    odd = [None, "", "no scheme", "http://", "://x", "http://com", "http://a.COM?x/y", "ftp://u@h:1/p?q://z/", "http://example.com.evil/en/", "http://" + "a" * 5000 + ".org/\u00e9"]
    rows += [(1000 + i, u) for i, u in enumerate(odd)] + [(None, odd[5]), (1, odd[5])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, gram int").repartition(3)
    out = urls.judge(spark, df, queries.URL_RULES).collect()
    assert len(out) == len(rows)

    def ruled(u):
        rest = (u or "").split("://", 1)[1] if "://" in (u or "") else ""
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in re.match(r"[^/?#]*", rest).group())
        path = re.match(r"[^/?#]*([^?#]*)", rest).group(1)
        fits = [(len(h + p), h + p, v) for h, p, v in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, path, max(fits)[1:] if fits else (None, None)

    for r in out:
        host, path, (rule, verdict) = ruled(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert verdict is None or r["verdict"] == verdict
    held = {r["u"] for r in df.select(F.coalesce("url", F.lit("")).alias("u")).where(F.pmod(F.xxhash64("u", F.lit("calibrate")), F.lit(5)) == 0).collect()}
    train = [(r["url"], r["verdict"]) for r in out if r["rule"] and r["url"] not in held]
    scores = {r["url"] or "": r["score"] for r in out if not r["rule"]}
    want = brute_scores(train, scores)
    assert all(abs(scores[u] - want[u]) < 1e-9 for u in scores) and len(scores) > 20
    assert scores[""] != 0  # an empty URL is scored by its end
    # one threshold divides the verdicts
    low = [r["score"] for r in out if not r["rule"] and r["verdict"] == "block"]
    high = [r["score"] for r in out if not r["rule"] and r["verdict"] == "allow"]
    assert low and high and max(low) < min(high)
    assert urls.judge(spark, df.limit(0), queries.URL_RULES).count() == 0


# ---------------------------------------------------------------- quality


def test_quality_counts_match_brute_force(spark, odd_documents):
    text = "the cat sat on the cat sat on\nthe cat\n\nthe cat\n \n# | <b> $5 100%\nthe cat"
    docs = odd_documents.select("doc_id", "text", "n").unionByName(spark.createDataFrame([(50, text, 1), (51, "a a a a", 1), (52, "a b", 1)], "doc_id long, text string, n int"))
    rows = quality_rules.judge(docs).collect()
    assert len(rows) == docs.count() and "n" in rows[0].asDict()
    for r in rows:
        t = r["text"] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        grams = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {i + k for i in range(len(w) - 2) if grams[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
        assert r["_qr_n_words"] == len(w) and r["_qr_word_chars"] == sum(map(len, w))
        assert r["_qr_n_symbols"] == sum(c in "#*$%&|<>" for c in t)
        assert r["_qr_n_dup_lines"] == len(lines) - len(set(lines))
        assert r["_qr_n_repeat_words"] == len(covered)
        assert r["_qr_base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r["_qr_kept"] and r["_qr_base_failed"])
    assert quality_rules.judge(docs.limit(0)).count() == 0


def test_quality_table_is_compiled(spark):
    docs = spark.createDataFrame([(1, "the " * 3 + "oak " * 60 + "elm fir pine larch " + " ".join(f"w{i}" for i in range(200)))], "doc_id long, text string")
    assert quality_rules.judge(docs, []).first()["_qr_kept"]
    assert not quality_rules.judge(docs, [("stop_words_per_word", 0.5, None)]).first()["_qr_kept"]


def test_pipe_tables_go_and_clean_prose_stays(spark):
    w = [f"w{i}" for i in range(120)]
    prose = " ".join(w[:60] + ["the", "of", "&", "and"] + w[60:])
    pipes = [" ".join(["the", "of"] + [f"{a} {b} |" for a, b in zip(w[::2], w[1::2], strict=True)]), " | ".join(w[:4]) + " the " + " | ".join(w[4:])]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([prose, *pipes])], "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    assert not any(r["_qr_base_failed"] for r in got.values())
    assert {d: r["_qr_kept"] for d, r in got.items()} == {0: True, 1: False, 2: False}


# ---------------------------------------------------------------- BPE


@pytest.mark.parametrize(("chunk", "overlap"), [(40, 16), (64, 5), (100_000, 100)])
def test_bpe_matches_the_library(spark, odd_documents, chunk, overlap):
    path, pattern = queries.bpe_files()
    rnd = random.Random(8)
    more = ["".join(rnd.choice(["word", " ", "  ", "\n", "don't", "\u00e9", "123", "!?", "\u4f60\u597d", "\u2003", "\x1c", "e\u0301"]) for _ in range(rnd.randint(0, 120))) for _ in range(60)]
    more += ["a" * 500, " " * 300, "x " * 200, "\n \n" * 50, "word" + " " * 100 + "word"]
    docs = odd_documents.select("doc_id", "text", "n").unionByName(spark.createDataFrame([(100 + i, t, 0) for i, t in enumerate(more)], "doc_id long, text string, n int"))
    enc = bpe.encoding(path, pattern)
    out = [(r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in bpe.encode(docs, path, pattern, chunk, overlap).collect()]
    want = [(r["doc_id"], tuple(enc.encode_ordinary(r["text"] or "")), (r["text"] or "").encode()) for r in docs.collect()]
    assert sorted(out, key=str) == sorted(want, key=str)
    assert bpe.encode(docs.limit(0), path, pattern).count() == 0


def in_chunks(enc, pattern, text, chunk, overlap):
    n = max(1, -(-len(text) // chunk))
    rows = []
    for p in range(n):
        own = text[p * chunk : (p + 1) * chunk + overlap]
        rows.append({"text": own[:chunk], **bpe.encode_chunk(enc, pattern, own, chunk, overlap, p + 1 == n)})
    return bpe.join_chunks(enc, pattern, rows, chunk, overlap)


def test_bpe_chunks_meet_at_common_boundaries():
    path, pattern = queries.bpe_files()
    enc, compiled = bpe.encoding(path, pattern), regex.compile(pattern)
    rnd = random.Random(5)
    parts = ["word", " ", "  ", "\n", "\r\n", "don't", "we'LL", "'", "''re", "é", "1234567", "!?", "你好", "今天天气很好。", "\u2003", "\x1c", "\x85", "e\u0301", "\t\t", "_", "“x”"]
    for trial in range(1500):
        some = rnd.sample(parts, rnd.randint(1, 6))
        text = "".join(rnd.choice(some) for _ in range(rnd.randint(0, 150)))
        chunk = rnd.choice([12, 30, 64])
        overlap = rnd.choice([3, 8, 11])
        assert in_chunks(enc, compiled, text, chunk, overlap)[0] == enc.encode_ordinary(text), (trial, text, chunk, overlap)
    # Chinese text, code and prose meet everywhere; a word longer than the overlap joins only the chunks it touches
    code = "def f(x):\n    return {'a': x[0] + 1, \"b\": f(x - 1)}\n\n" * 4000
    for text in ("今天天气很好。" * 20_000, code, "It's fine. " * 20_000):
        ids, together = in_chunks(enc, compiled, text, bpe.CHUNK_CHARS, bpe.OVERLAP_CHARS)
        assert ids == enc.encode_ordinary(text) and together == 0
    text = "some words " * 30_000 + "x" * 40_000 + " and more" * 30_000
    ids, together = in_chunks(enc, compiled, text, bpe.CHUNK_CHARS, bpe.OVERLAP_CHARS)
    assert ids == enc.encode_ordinary(text) and 0 < together <= 3
    text = "a " * 10_000 + " " * 200_000 + "b"
    ids, together = in_chunks(enc, compiled, text, bpe.CHUNK_CHARS, bpe.OVERLAP_CHARS)
    assert ids == enc.encode_ordinary(text) and together <= 8


def test_bpe_digest(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, None)], "doc_id long, text string")
    ids = bpe.encoding(*queries.bpe_files()).encode_ordinary("hello world")
    got = {r["doc_id"]: r for r in queries.bpe_digest(bpe.encode(df, *queries.bpe_files())).collect()}
    assert got[1]["n_tokens"] == len(ids) and got[1]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert got[2]["n_tokens"] == 0 and got[2]["ids_sha256"] == got[2]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- language


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_language_on_held_out_documents(spark):
    docs = queries.table(spark, SF, "documents").select("doc_id", "text", "lang", "source")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    out = {r["doc_id"]: r for r in langid.identify(spark, docs).withColumn("held", langid.held_out()).collect()}
    held = [r for r in out.values() if r["held"]]
    assert len(held) > 20 and sum(r["_lid_lang"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["_lid_score"] <= 1 for r in out.values())
    # what a held-out document says about itself changes nothing
    lies = docs.withColumn("lang", F.when(langid.held_out(), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    again = {r["doc_id"]: (r["_lid_lang"], r["_lid_score"]) for r in langid.identify(spark, lies).collect()}
    assert all(again[d] == (r["_lid_lang"], r["_lid_score"]) for d, r in out.items())


def test_language_edge_cases(spark, odd_documents):
    out = langid.identify(spark, odd_documents)
    assert out.columns[: len(odd_documents.columns)] == odd_documents.columns
    for r in out.collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["_lid_lang"] == "und") == (not letters) and (letters or r["_lid_score"] == 0)
    nobody = odd_documents.withColumn("lang", F.lit(None).cast("string"))
    assert {r["_lid_lang"] for r in langid.identify(spark, nobody).collect()} == {"und"}
    assert langid.identify(spark, odd_documents.limit(0)).count() == 0


def plain_ngrams(text):
    """Bins of a text's n-grams, one character after the other."""
    c, m = [ord(x) for x in f" {text.lower()} "], (1 << 32) - 1
    out = Counter()
    for order, n in enumerate(langid.ORDERS):
        for i in range(len(c) - n + 1):
            h = c[i] * 2654435761 & m
            for t in range(1, n):
                h = ((h ^ h >> 15) * 2246822519 + c[i + t] * 3266489917) & m
            h = (h ^ h >> 13) * 2654435769 & m
            out[(h >> (32 - langid.BINS.bit_length() + 1)) + order * langid.BINS] += 1
    return out, len(c)


def plain_model(texts, labels, draws, names):
    """TF-IDF, follow-the-regularised-leader and temperature with plain numbers."""
    grams = [plain_ngrams(t) for t in texts]
    df = Counter(b for g, _ in grams for b in g)
    idf = {b: math.log((1 + len(texts)) / (1 + n)) + 1e-3 for b, n in df.items()}
    rows = [[(b, n / size * idf[b] * langid.SCALE) for b, n in g.items()] + [(-1, 1.0)] for g, size in grams]
    order = sorted(range(len(texts)), key=lambda i: draws[i])
    held = set(order[::5]) if len(texts) >= 50 else set()
    k = len(names)
    z, n = defaultdict(lambda: [0.0] * k), defaultdict(lambda: [0.0] * k)

    def weight(b, c):
        l1 = 0.0 if b == -1 else langid.L1
        if abs(z[b][c]) <= l1:
            return 0.0
        return -(z[b][c] - math.copysign(l1, z[b][c])) / ((langid.BETA + math.sqrt(n[b][c])) / langid.ALPHA + langid.L2)

    def logits(row):
        return [sum(x * weight(b, c) for b, x in row) for c in range(k)]

    def softmax(v):
        e = [math.exp(x - max(v)) for x in v]
        return [x / sum(e) for x in e]

    for _ in range(langid.EPOCHS):
        for i in order:
            if i in held:
                continue
            p = softmax(logits(rows[i]))
            p[names.index(labels[i])] -= 1
            old = {b: [weight(b, c) for c in range(k)] for b, _ in rows[i]}
            for b, x in rows[i]:
                for c in range(k):
                    g = x * p[c]
                    z[b][c] += g - (math.sqrt(n[b][c] + g * g) - math.sqrt(n[b][c])) / langid.ALPHA * old[b][c]
                    n[b][c] += g * g

    known = [(logits(rows[i]), names.index(labels[i])) for i in held]

    def loss(t):
        return sum(-math.log(softmax([x / math.exp(t) for x in v])[y] + 1e-12) for v, y in known) / len(known)

    t = min((k / 1000 for k in range(-4000, 4001)), key=loss) if held else 0.0
    return lambda text: softmax([x / math.exp(t) for x in logits([(b, n / size * idf[b] * langid.SCALE) for g, size in [plain_ngrams(text)] for b, n in g.items() if b in idf] + [(-1, 1.0)])])


def toy_documents(spark, n, ids=lambda i: i):
    rnd = random.Random(n)
    kinds = {"aa": "banana papaya cassava", "bb": "tree street sleeve", "cc": "io lilo pillion"}
    rows = [(ids(i), " ".join(rnd.choice(kinds[k].split()) for _ in range(rnd.randint(3, 9))) + f" {i}", k) for i in range(n) for k in [rnd.choice(sorted(kinds))]]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_model_matches_plain_arithmetic(spark):
    rows, docs = toy_documents(spark, 90)
    marked = docs.withColumn("draw", F.xxhash64("doc_id", "text", F.lit("langid"))).withColumn("bucket", F.pmod(F.xxhash64("draw", F.lit("bucket")), F.lit(langid.PER_LANGUAGE))).collect()
    least = {}
    for r in marked:
        least[r["lang"], r["bucket"]] = min(least.get((r["lang"], r["bucket"]), r["draw"]), r["draw"])
    drawn = [r for r in marked if least[r["lang"], r["bucket"]] == r["draw"]]
    assert len(drawn) == len(rows)  # idf is over all of them, as the fit is
    ask = plain_model([r["text"] for r in drawn], [r["lang"] for r in drawn], [r["draw"] for r in drawn], ["aa", "bb", "cc"])
    got = langid.predict(docs, langid.train(spark, docs, F.lit(True))).collect()
    for r in got:
        p = ask(r["text"])
        assert r["_lid_lang"] == ["aa", "bb", "cc"][p.index(max(p))] and abs(r["_lid_score"] - max(p)) < 5e-3


def test_one_id_or_none_on_very_many_rows_still_trains(spark):
    for one in (7, 0, None):
        rows, docs = toy_documents(spark, 3000, lambda i, one=one: one)
        seen = []
        fit = langid._sample
        try:
            langid._sample = lambda *a: seen.append(fit(*a)) or seen[-1]
            out = langid.predict(docs, langid.train(spark, docs, F.lit(True), per_language=200)).collect()
        finally:
            langid._sample = fit
        assert 300 < seen[0].count() <= 600 and sum(r["_lid_lang"] == r["lang"] for r in out) > 0.99 * len(out)
    same = docs.limit(1).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(2000)))).drop("k")
    out = langid.identify(spark, same).select("_lid_lang", "lang").distinct().collect()
    assert len(out) == 1 and out[0][0] == out[0][1]


def test_more_languages_than_a_group(spark, monkeypatch):
    monkeypatch.setattr(langid, "GROUP", 4)
    names = [f"l{k:02d}" for k in range(10)]
    rnd = random.Random(4)
    own = {x: ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(3)] for x in names}
    rows = [(i, " ".join(rnd.choice(own[x]) for _ in range(8)), x) for i in range(600) for x in [names[i % 10]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    out = langid.identify(spark, docs).collect()
    assert sum(r["_lid_lang"] == r["lang"] for r in out) > 0.95 * len(out) and all(0 < r["_lid_score"] <= 1 for r in out)


def test_three_hundred_languages(spark):
    rows = [(i, f"{'abcdefghij'[i % 10] * 3} {'klmnopqrst'[i // 10 % 10] * 3} {'uvwxyz'[i // 100 % 3] * 3}", f"l{i % 300}") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = langid.identify(spark, docs).collect()
    assert {r["_lid_lang"] for r in out} <= {f"l{k}" for k in range(300)} and sum(r["_lid_lang"] == r["lang"] for r in out) > 0.5 * len(out)

"""The registered queries of the dealt operators: thin digests over each operator's own output."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmeter.llm import alignment, bpe, chat, langid, mixing, prefix_trie, quality_rules, secrets, sharding, simhash, substring, urls, vector_join
from hourmeter.session import checkpoint_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, words removed and the digest of the kept words."""
    out = substring.remove_repeats(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_sub_n_words").alias("n_words"), F.col("_sub_n_removed").alias("n_removed"), F.sha2("_sub_kept_text", 256).alias("kept_sha256"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation, read back from the rendered string: turns, their digest and the text under the loss mask."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    more = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(hard).alias("text")) for k, r in enumerate(("user", "assistant"))])))
    out = chat.format_chats(turns.unionByName(more))
    out = out.withColumns({"said": chat.parsed(F.col("formatted")), "loss": chat.loss_text(F.col("formatted"), F.col("loss_spans"))})
    told = F.array_join(F.transform("said", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("said").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP2_SQL = """
with t as (
  select conv_id, turn, coalesce(role, '') role, coalesce(text, '') text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e as (
  select *, replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), chr(10), '&#10;') er,
    replace(replace(text, '&', '&amp;'), '<', '&lt;') et from t
)
select conv_id, count(*) n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) loss_sha256,
  sum(length('<|im_start|>') + length(er) + 1 + length(et) + length('<|im_end|>') + 1)::bigint formatted_chars
from e group by conv_id
"""


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector: links at cosine 0.98 or more inside its label, and its component."""
    return vector_join.near_duplicates(spark, table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), cosine=0.98)


OLD_SHARDS, NEW_SHARDS = 12, 16


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents from 12 old shards into 16 of near equal bytes, read back from the rewritten shards' files; a
    shard that nothing touched has no new files."""
    old = sharding.old_shard_by_hash(OLD_SHARDS)
    out = sharding.reshard(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), old, NEW_SHARDS)
    path = f"{checkpoint_root(spark).rstrip('/')}/llm-shards-{uuid.uuid4().hex}"
    touched = sharding.rewrite(out, path, NEW_SHARDS)
    back = spark.read.schema(out.drop("_sh_old", "_sh_new").withColumn("shard", F.lit(0)).schema).parquet(path)
    untouched = out.where(~F.col("_sh_new").isin(touched)).withColumn("shard", F.col("_sh_new")).select(back.columns)
    return sharding.with_size(back.unionByName(untouched)).select(
        "doc_id", F.col("_sh_size").alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", F.col("_sh_slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), old.alias("old_shard")
    )


#: The contract's rules: host, path, verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: host, path, the longest rule that fits, and the rule's or the language models' verdict."""
    return urls.judge(spark, table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the base counts, the base verdict and the threshold table's verdict."""
    out = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return out.select("doc_id", *[F.col(f"_qr_{n}").alias(n) for n in names])


_STOP_SQL = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)
_TABLE_SQL = " and ".join(
    [f"{name} >= {low}" for name, low, _ in quality_rules.THRESHOLDS if low is not None] + [f"{name} <= {high}" for name, _, high in quality_rules.THRESHOLDS if high is not None]
)
OP6_SQL = f"""
with w as (
  select doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) ls
  from documents
), r as (
  select row_number() over () rid, *, len(ws) n from w
), g as (
  select rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] g
  from (select rid, ws, unnest(range(1, n - 1)) i from r where n >= 3)
), d as (
  select rid, i from (select rid, i, count(*) over (partition by rid, g) c from g) where c > 1
), p as (
  select rid, count(distinct i + k) n_repeat from d, (values (0), (1), (2)) o(k) group by rid
), m as (
  select doc_id, n, len(array_to_string(ws, '')) word_chars, len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) n_symbols,
    len(ls) n_lines, len(ls) - len(list_distinct(ls)) n_dup, coalesce(n_repeat, 0) n_repeat,
    len(list_filter(ws, lambda x: x in ({_STOP_SQL}))) n_stop
  from r left join p using (rid)
), f as (
  select *, n < {quality_rules.MIN_WORDS} or 100 * n_repeat > {quality_rules.MAX_REPEAT_PERCENT} * n base_failed,
    case when n > 0 then word_chars / n else 0 end mean_word_chars, case when n > 0 then n_symbols / n else 0 end symbols_per_word,
    case when n > 0 then n_stop / n else 0 end stop_words_per_word, case when n_lines > 0 then n_dup / n_lines else 0 end dup_lines_per_line
  from m
)
select doc_id, n::bigint n_words, word_chars::bigint word_chars, n_symbols::bigint n_symbols, n_dup::bigint n_dup_lines,
  n_repeat::bigint n_repeat_words, base_failed, not base_failed and {_TABLE_SQL} kept
from f
"""


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: fingerprint and smallest doc_id reachable by links of at most two bits."""
    return simhash.simhash_groups(spark, table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def bpe_files() -> tuple[str, str]:
    """Rank file and pre-token pattern of the public byte-level tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def bpe_digest(encoded: DataFrame, *more: str) -> DataFrame:
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), *more)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number and digest of its ids, and digest of the bytes decoded from them."""
    return bpe_digest(bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), *bpe_files()))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its source's size and target, and the words that the mix takes of it."""
    out = mixing.copies(spark, table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    out = out.withColumn("taken", (F.col("size") * F.col("copies")).cast("long"))
    out = out.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: whether it was held out, the predicted language and its calibrated probability."""
    out = langid.identify(spark, table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return out.select("doc_id", langid.held_out().alias("held_out"), F.col("_lid_lang").alias("lang_pred"), F.col("_lid_score").alias("score"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: tokens of both tokenizers, groups, links, and the links' corpus-wide counts."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out, _ = alignment.align(spark, docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return out


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: spans of the fixed patterns, and all spans with those of random keys."""
    out = secrets.scan(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.transform("base", lambda s: s["kind"])
    counted = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k, _ in secrets.PATTERNS]
    return out.select("doc_id", *counted, F.sha2(secrets.told(F.col("base")), 256).alias("base_sha256"), secrets.told(secrets.in_order(F.col("base"), F.col("added"))).alias("spans"))


def _sql_matches(name: str, source: str, pattern: str) -> str:
    """Matches of a pattern with their offsets, from the lengths of matches and of the text between."""
    return f"""{name} as (
  select rid, t[i] s, list_sum(list_transform(g[1:i], lambda x: length(x)))::bigint + coalesce(list_sum(list_transform(t[1:i - 1], lambda x: length(x))), 0)::bigint lo
  from (select rid, t, g, unnest(range(1, len(t) + 1)) i from (select rid, regexp_extract_all(text, '{pattern}') t, string_split_regex(text, '{pattern}') g from {source}))
)"""


_SQL_ASSIGN = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
_SQL_TAIL = (
    "case when z >= 0 then q else 1 - q end from (select *, exp(-z * z / 2) / sqrt(2 * 3.141592653589793) * u * (0.319381530 + u * (-0.356563782 + u * (1.781477937 + u * (-1.821255978 + u * 1.330274429)))) q "
    "from (select *, 1 / (1 + 0.2316419 * abs(z)) u from {}))"
)
OP12_SQL = f"""
with r as (
  select row_number() over () rid, doc_id, coalesce(text, '') as text from documents
), {_sql_matches("m_assign", "r", _SQL_ASSIGN)}, {_sql_matches("m_access", "r", "AKIA[A-Z0-9]+")}, {_sql_matches("m_hex", "r", "[0-9a-f]+")},
{_sql_matches("m_key", "r", "[A-Za-z0-9+/_-]{20,}")}, base as (
  select rid, 0 place, 'assign' kind, lo, lo + length(s) stop from m_assign where length(regexp_extract(s, '{_SQL_ASSIGN}', 2)) >= 6
  union all select rid, 1, 'access', lo, lo + length(s) from m_access where length(s) >= 20
  union all select rid, 2, 'hex', lo, lo + length(s) from m_hex where length(s) >= 24
), e as (
  select rid, lo, s, case
    when regexp_full_match(s, '[0-9a-f]+') and s ~ '.*[0-9].*' and s ~ '.*[a-f].*' then '0123456789abcdef'
    when regexp_full_match(s, '[0-9A-F]+') and s ~ '.*[0-9].*' and s ~ '.*[A-F].*' then '0123456789ABCDEF'
    when regexp_full_match(s, '[A-Z2-7]+') and s ~ '.*[2-7].*' and s ~ '.*[A-Z].*' then 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'
    when regexp_full_match(s, '[0-9a-z]+') and s ~ '.*[0-9].*' and s ~ '.*[a-z].*' then '0123456789abcdefghijklmnopqrstuvwxyz'
    when regexp_full_match(s, '[0-9A-Z]+') and s ~ '.*[0-9].*' and s ~ '.*[A-Z].*' then '0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ'
    when not (s ~ '.*[0-9].*' and s ~ '.*[A-Z].*' and s ~ '.*[a-z].*') then null
    when regexp_full_match(s, '[0-9A-Za-z]+') then '0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz'
    when regexp_full_match(s, '[0-9A-Za-z+/]+') then 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/'
    when regexp_full_match(s, '[0-9A-Za-z_-]+') then 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_'
  end alphabet from m_key
), keys as (
  select distinct s, alphabet, length(s)::double n, length(alphabet)::double a from e where alphabet is not null
), c as (
  select s, i, instr(alphabet, substr(s, i, 1)) - 1 v, n, a from (select *, unnest(range(1, length(s) + 1)) i from keys)
), stat as (
  select s, any_value(n) n, any_value(a) a, sum(v)::double sv, sum(v * v)::double sq, sum(v * w)::double sp, sum((v >= a // 2)::int)::double ones,
    1.0 + count(*) filter (i > 1 and (v >= a // 2) <> (p >= a // 2)) n_runs
  from (select *, coalesce(lead(v) over o, first_value(v) over o) w, lag(v) over o p from c window o as (partition by s order by i)) group by s
), twice as (
  select s, sum(k * k)::double squares from (select s, v, count(*) k from c group by s, v) group by s
), scored as (
  select *, (n * sp - sv * sv) / nullif(n * sq - sv * sv, 0) serial, 1 + 2 * ones * (n - ones) / n mean,
    (a / n * squares - n) * n / (n - 1) / ((a - 1) * n / (n - 1)) per, (a - 1) * n / (n - 1) free from stat join twice using (s)
), z as (
  select s, 1 test, (pow(greatest(per, 0), 1.0 / 3) - (1 - 2 / (9 * free))) / sqrt(2 / (9 * free)) z from scored
  union all select s, 2, case when (mean - 1) * (mean - 2) > 0 then abs(n_runs - mean) / sqrt((mean - 1) * (mean - 2) / (n - 1)) end from scored
  union all select s, 3, abs(serial + 1 / (n - 1)) / sqrt(n * n / ((n - 1) * (n - 1) * (n - 2))) from scored
), tails as (
  select s, test, {_SQL_TAIL.format("z")}
), halves as (
  select s, -sum(ln(greatest(least(coalesce(case when test = 1 then p else 2 * p end, 0), 1), 1e-300))) h from tails t(s, test, p) group by s
), judged as (
  select s, alphabet, floor(2 * log2(n))::int size, exp(-h) * (1 + h + h * h / 2) p from halves join keys using (s)
), stepped as (
  select *, case when p < 0.001 then 0 else least(floor(p * 100), 99) + 1 end step from judged
), counted as (
  select alphabet, size, step, count(*) n from stepped group by all
), bounds as (
  select alphabet, size, min(step) bound from (
    select *, (upper + sqrt(upper)) * 1.25 * (1 - case when step = 1 then 0.001 else (step - 1) / 100.0 end) expected
    from (select *, sum(case when step > 20 then n else 0 end) over (partition by alphabet, size) upper, sum(n) over (partition by alphabet, size order by step desc) accepted from counted))
  where step > 0 and 1 - expected / accepted <= 0.05 group by all
), added as (
  select rid, 3 place, 'random' kind, e.lo, e.lo + length(e.s) stop from e join stepped x using (s) join bounds b on b.alphabet = x.alphabet and b.size = x.size and step >= bound
  where not exists (select 1 from base where base.rid = e.rid and base.lo <= e.lo and base.stop >= e.lo + length(e.s))
), told as (
  select rid, string_agg(concat_ws(':', kind, lo, stop), ',' order by lo, place) filter (place < 3) base, string_agg(concat_ws(':', kind, lo, stop), ',' order by lo, place) spans,
    count(*) filter (kind = 'assign') n_assign, count(*) filter (kind = 'access') n_access, count(*) filter (kind = 'hex') n_hex
  from (select * from base union all select * from added) group by rid
)
select doc_id, coalesce(n_assign, 0)::bigint n_assign, coalesce(n_access, 0)::bigint n_access, coalesce(n_hex, 0)::bigint n_hex,
  sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans
from r left join told using (rid)
"""


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per node of the rebuilt conversations' prefix trie: members, children, leaves, saved tokens and who ends there."""
    turns = prefix_trie.numbered(spark, table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    rebuilt, convs = prefix_trie.shared_heads(turns, 20, F.crc32(F.col("conv_id").cast("string")) % 4)
    return prefix_trie.trie(spark, rebuilt, convs)


#: crc32 bit by bit: a conv_id's digits are folded one after the other, eight halvings each.
_CRC_BIT = "case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end"
OP13_SQL = f"""
with recursive t as (
  select conv_id, coalesce(role, '') role, coalesce(text, '') text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) pos
  from conversations where conv_id is not null
), crc as (
  select conv_id, 0 k, 4294967295::bigint c from (select distinct conv_id from t)
  union all
  select conv_id, k + 1, case when k % 9 = 0 then xor(c, ascii(substr(conv_id::varchar, k // 9 + 1, 1))) else {_CRC_BIT} end
  from crc where k < 9 * length(conv_id::varchar)
), convs as (
  select conv_id, xor(c, 4294967295) % 4 h, conv_id - conv_id % 20 base from crc where k = 9 * length(conv_id::varchar)
), has as (
  select c.conv_id, h, count(b.pos) m from convs c left join t b on b.conv_id = c.base and b.pos <= h group by all
), rebuilt as (
  select c.conv_id, b.pos, role, text from convs c join t b on b.conv_id = c.base and b.pos <= h
  union all select t.conv_id, t.pos - h + m, role, text from t join has using (conv_id) where t.pos > h
), path as (
  select conv_id, pos depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) words,
    string_agg(sha256(role || chr(10) || text), '/') over (partition by conv_id order by pos) node
  from rebuilt union all select conv_id, 0, 0, '' from convs
), deep as (
  select conv_id, max(depth) n from path group by conv_id
), nodes as (
  select node, depth, min(p.conv_id) conv_id, count(*) n_convs, any_value(words) words, string_agg(case when depth = n then p.conv_id end::varchar, ',' order by p.conv_id) ends
  from path p join deep d on d.conv_id = p.conv_id group by node, depth
), up as (
  select n.node, n.depth, p.node parent from nodes n join path p on p.conv_id = n.conv_id and p.depth = n.depth - 1
), kids as (
  select parent node, count(*) n_children from up group by parent
), below as (
  select a.node, a.depth, sum((y.n_convs - 1) * y.words) saved_tokens, count(*) filter (y.node not in (select node from kids)) n_leaves
  from nodes y join path a on a.conv_id = y.conv_id and a.depth <= y.depth group by a.node, a.depth
)
select n.conv_id, n.depth::bigint as depth, q.conv_id parent_conv_id, n.n_convs, coalesce(n_children, 0)::bigint n_children, n_leaves::bigint n_leaves,
  saved_tokens::bigint saved_tokens, sha256(coalesce(n.ends, '')) ends_sha256
from nodes n join below using (node) left join kids using (node) left join up using (node) left join nodes q on q.node = up.parent
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_chat_format": op2_chat_format,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_sharding": op4_sharding,
    "op5_url_filter": op5_url_filter,
    "op6_quality_rules": op6_quality_rules,
    "op7_simhash": op7_simhash,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_mixing": op9_mixing,
    "op10_language_id": op10_language_id,
    "op11_token_alignment": op11_token_alignment,
    "op12_secret_scan": op12_secret_scan,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE: dict[str, str] = {"op2_chat_format": OP2_SQL, "op6_quality_rules": OP6_SQL, "op12_secret_scan": OP12_SQL, "op13_prefix_trie": OP13_SQL}

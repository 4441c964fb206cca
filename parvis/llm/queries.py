"""The registered queries of this subpackage; each reads its whole intended table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat_format,
    decontaminate,
    line_dedup,
    packing,
    prefix_trie,
    quality,
    sharding,
    simhash,
    spelling,
    substring_dedup,
    toxicity,
    url_filter,
    warc_zip,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_line_dedup(spark, sf):
    done = line_dedup.dedup_lines(table(spark, sf, "documents"), min_chars=40, min_docs=5)
    return done.select("row.doc_id", "n_lines", "n_dropped", "kept_sha256")


@query
def op2_warc_zip(spark, sf):
    records = warc_zip.round_trip(table(spark, sf, "pages"), min_bytes=0)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op3_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), capacity=2048)


@query
def op4_url_filter(spark, sf):
    return url_filter.judge(table(spark, sf, "pages"))


@query
def op5_simhash(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query
def op6_sharding(spark, sf):
    return sharding.shard(table(spark, sf, "documents"), n_shards=8)


@query
def op7_quality(spark, sf):
    judged = quality.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return judged.select("doc_id", *quality.FEATURES, "base_failed", "kept")


@query
def op8_decontamination(spark, sf):
    return decontaminate.matches(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op9_substring_dedup(spark, sf):
    return substring_dedup.remove_repeats(table(spark, sf, "documents"), window=35)


@query
def op10_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = toxicity.fit(docs, table(spark, sf, "labels"), train=~held_out)
    scored = toxicity.score(docs, model, F.col("doc_id"))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op11_prefix_trie(spark, sf):
    return prefix_trie.prefix_trie(table(spark, sf, "conversations"), family=100, most=6)


@query
def op12_spelling_variants(spark, sf):
    return spelling.variants(table(spark, sf, "documents"), min_chars=7, min_count=2, factor=10, drop_mod=31)


@query
def op13_chat_format(spark, sf):
    """All conversations, and one more whose turns consist of control strings."""
    given = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    formatted = chat_format.format_conversations(given.unionByName(more), trained_role="assistant")
    return chat_format.read_back(formatted)


# CRC-32 as a sum over bytes; its table follows from the polynomial.
CRC_TABLE = """select list(c order by i) as t from (
    select i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
    from range(256) r(i))"""


def crc32_sql(byte_list: str) -> str:
    """CRC-32 of a list of bytes, with the table ``t`` in reach."""
    step = "lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {byte_list}), {step}), 4294967295)"


def bytes_sql(text: str) -> str:
    digit = "(instr('0123456789ABCDEF', substr(h, {}, 1)) - 1)"
    pairs = f"16 * {digit.format('2 * i + 1')} + {digit.format('2 * i + 2')}"
    return f"list_transform(range(strlen({text})), lambda i: (({pairs.replace('substr(h', f'substr(hex({text})')}))::bigint)"


CONTROL_SQL = [("<", "s>|/s>|\\|endoftext\\|>|\\|im_start\\|>|\\|im_end\\|>"), ("\\[", "INST\\]|/INST\\]")]


def escaped_sql(text: str) -> str:
    for first, rest in CONTROL_SQL:
        text = f"regexp_replace({text}, '({first})(\\\\*)({rest})', '\\1\\\\\\2\\3', 'g')"
    return text


# Rules, cuts, windows and sums that SQL can express; DuckDB has no XXH64 on seeds, tokenizers or fitted models.
ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": """
        with lines as (
            select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
            from documents
        ),
        stripped as (
            select *, regexp_replace(regexp_replace(line, '^[ \\t-\\r]+', ''), '[ \\t-\\r]+$', '') as core from lines
        ),
        keyed as (
            select *, translate(core, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from stripped
        ),
        common as (
            select key, max(doc_id) as holder from keyed where length(key) >= 40
            group by key having count(distinct doc_id) >= 5
        ),
        marked as (
            select k.doc_id, k.pos, k.line, c.key is not null and k.doc_id <> c.holder as dropped
            from keyed k left join common c using (key)
        )
        select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
        from marked group by doc_id
    """,
    "op2_warc_zip": """
        with payloads as (
            select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as sha from pages
        ),
        first as (select *, min(page_id) over (partition by sha) as first_id from payloads),
        digits as (
            select *, list_transform(range(0, 32), lambda i: list_sum(list_transform(range(0, 5), lambda j:
                (((instr('0123456789abcdef', substr(sha, (5 * i + j) // 4 + 1, 1)) - 1) >> (3 - (5 * i + j) % 4)) & 1)
                << (4 - j)))) as d
            from first
        )
        select page_id, strlen(payload) as payload_bytes,
               array_to_string(list_transform(d, lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', x::int + 1, 1)), '') as payload_digest,
               case when page_id = first_id then 'response' else 'revisit' end as record_type,
               case when page_id <> first_id then first_id end as refers_to
        from digits
    """,
    "op9_substring_dedup": """
        with split as (
            select doc_id, regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+') as words from documents
        ),
        placed as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) as pos from split),
        two as (select *, md5(word || ' ' || lead(word) over w) as k2 from placed window w as (partition by doc_id order by pos)),
        four as (select *, md5(k2 || lead(k2, 2) over w) as k4 from two window w as (partition by doc_id order by pos)),
        eight as (select *, md5(k4 || lead(k4, 4) over w) as k8 from four window w as (partition by doc_id order by pos)),
        sixteen as (select *, md5(k8 || lead(k8, 8) over w) as k16 from eight window w as (partition by doc_id order by pos)),
        windows as (
            select doc_id, pos, word,
                   md5(k16 || lead(k16, 16) over w || lead(k2, 32) over w || ' ' || lead(word, 34) over w) as key
            from sixteen window w as (partition by doc_id order by pos)
        ),
        marked as (select *, key is not null and count(*) over (partition by key) > 1 as repeats from windows),
        covered as (
            select *, bool_or(repeats) over (partition by doc_id order by pos rows between 34 preceding and current row) as gone
            from marked
        ),
        kept as (
            select doc_id, count(*) as n_words, count(*) filter (where gone) as n_removed,
                   string_agg(word, ' ' order by pos) filter (where not gone) as body
            from covered group by doc_id
        )
        select doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(body, '')) as kept_sha256
        from documents left join kept using (doc_id)
    """,
    "op11_prefix_trie": f"""
        with crc as ({CRC_TABLE}),
        turns as (
            select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
                   md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) as digest,
                   row_number() over (partition by conv_id order by turn nulls first,
                       md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) as i
            from conversations where conv_id is not null
        ),
        convs as (
            select conv_id, conv_id - conv_id % 100 as base,
                   {crc32_sql("list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)")} % 6 as h
            from (select distinct conv_id from turns), crc
        ),
        parts as (
            select c.conv_id, 0 as part, b.i, b.digest, b.text from convs c join turns b on b.conv_id = c.base and b.i <= c.h
            union all
            select c.conv_id, 1, t.i, t.digest, t.text from convs c join turns t on t.conv_id = c.conv_id and t.i > c.h
        ),
        placed as (
            select conv_id, row_number() over (partition by conv_id order by part, i) as depth, digest, length(text) as n_chars from parts
            union all
            select conv_id, 0, '', 0 from convs
        ),
        keyed as (
            select *, string_agg(digest, '') over (partition by conv_id order by depth) as key,
                   max(depth) over (partition by conv_id) as length
            from placed
        ),
        linked as (select *, lag(key) over (partition by conv_id order by depth) as parent from keyed),
        nodes as (
            select depth, key, min(conv_id) as conv_id, count(*) as n_convs, any_value(n_chars) as n_chars,
                   any_value(parent) as parent,
                   sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where depth = length), '')) as ends_sha256
            from linked group by depth, key
        ),
        children as (select depth - 1 as depth, parent as key, count(*) as n_children from nodes where depth > 0 group by all),
        tree as (select n.*, coalesce(c.n_children, 0) as n_children from nodes n left join children c using (depth, key)),
        own as (
            select k.conv_id, k.depth, k.key,
                   case when t.conv_id = k.conv_id then (t.n_convs - 1) * t.n_chars else 0 end as saving,
                   case when t.conv_id = k.conv_id and t.n_children = 0 then 1 else 0 end as leaf
            from linked k join tree t using (depth, key)
        ),
        below as (
            select depth, key, sum(saving) over w as saving, sum(leaf) over w as leaves
            from own window w as (partition by conv_id order by depth desc)
        ),
        totals as (select depth, key, sum(saving)::bigint as saved_tokens, sum(leaves)::bigint as n_leaves from below group by depth, key)
        select t.conv_id, t.depth, p.conv_id as parent_conv_id, t.n_convs, t.n_children, b.n_leaves, b.saved_tokens, t.ends_sha256
        from tree t join totals b using (depth, key) left join tree p on p.depth = t.depth - 1 and p.key = t.parent
    """,
    "op12_spelling_variants": f"""
        with recursive crc as ({CRC_TABLE}),
        runs as (
            select coalesce(doc_id::varchar, '') as who, unnest(regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00C0-\u00FF]+')) as run
            from documents
        ),
        counted as (select who, run, concat(who, ':', run) as spelled, count(*) as n from runs where length(run) >= 7 group by all),
        hashed as (select run, n, {crc32_sql(bytes_sql("spelled"))} as h from counted, crc),
        kept as (
            select case when h % 31 = 0 then concat(left(run, (h % length(run))::int), substr(run, (h % length(run))::int + 2)) else run end as word, n
            from hashed
        ),
        words as (select word, sum(n)::bigint as n from kept where length(word) >= 7 group by word having sum(n) >= 2),
        cuts as (
            select word, i, concat(left(word, i), substr(word, i + 2)) as rest
            from (select word, unnest(range(length(word))) as i from words)
        ),
        near as (
            select a.word, b.word as other from cuts a join cuts b on a.i = b.i and a.rest = b.rest and a.word <> b.word
            union
            select a.word, b.word from cuts a join words b on a.rest = b.word
            union
            select b.word, a.word from cuts a join words b on a.rest = b.word
        ),
        best as (
            select near.word, count(*) as n_near, first(w.word order by w.n desc, w.word) as form, max(w.n) as form_n
            from near join words w on w.word = near.other group by near.word
        ),
        forms as (
            select w.word, w.n, coalesce(b.n_near, 0) as n_near,
                   case when b.form_n >= 10 * w.n then b.form end as form, case when b.form_n >= 10 * w.n then b.form_n end as form_n
            from words w left join best b using (word)
        ),
        chains as (
            select word, word as root, form as next from forms
            union all
            select c.word, f.word, f.form from chains c join forms f on f.word = c.next
        )
        select f.word, f.form, c.root, f.n, f.n_near, f.form_n from forms f join chains c on c.word = f.word and c.next is null
    """,
    "op13_chat_format": f"""
        with given as (
            select conv_id, turn, role, text from conversations
            union all
            select -1, i, case i when 0 then 'user' else 'assistant' end, '</s>[INST] ok [/INST]' from range(2) r(i)
        ),
        turns as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
                   md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) as digest
            from given
        )
        select conv_id, count(*) as n_turns,
               sha256(string_agg(concat(role, chr(10), text, chr(10)), '' order by turn nulls first, digest)) as turns_sha256,
               coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn nulls first, digest) filter (where role = 'assistant'), '')) as loss_sha256,
               sum(17 + length({escaped_sql("role")}) + length({escaped_sql("text")}))::bigint as formatted_chars
        from turns group by conv_id
    """,
}

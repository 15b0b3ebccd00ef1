"""Registered queries of this package and their SQL for DuckDB."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import bpe, decontam, hilbert, jaccard, ngram, orc_tokens, passages, quoting, repair, spelling, toxicity, warc, winnow
from tickloom.llm.common import shared_dir, table


def op1_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "tokens")
    orc_tokens.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return orc_tokens.catalogue(orc_tokens.read_tokens(spark, path))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    arc, out = shared_dir(spark, "arc"), shared_dir(spark, "warc")
    warc.write_arc(table(spark, sf_dir, "pages"), arc)
    warc.arc_to_warc(spark, arc, out)
    return warc.read_warc(spark, out, payloads=False).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to_key").alias("refers_to"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"), n=3, percent=90)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = passages.without_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.document_fingerprints(table(spark, sf_dir, "documents"))


def op8_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations hold no quotes, so they are first given the form of a mail archive, every message and its whole text."""
    return quoting.linked_messages(quoting.as_replies(table(spark, sf_dir, "conversations")))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), decode=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op10_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.document_shards(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired_digests(repair.damaged(table(spark, sf_dir, "conversations")), copies="copies")


def op12_ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ngram.scored(docs, ngram.train(docs))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(spelling.vocabulary(table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_orc_tokens": op1_orc_tokens,
    "op2_decontamination": op2_decontamination,
    "op3_arc_to_warc": op3_arc_to_warc,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_toxicity": op5_toxicity,
    "op6_passages": op6_passages,
    "op7_winnowing": op7_winnowing,
    "op8_quotation_links": op8_quotation_links,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_hilbert_shards": op10_hilbert_shards,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_ngram_scores": op12_ngram_scores,
    "op13_spelling_variants": op13_spelling_variants,
}

#: crc32 of the list of bytes ``{bytes}`` with the table ``t`` of ``CRC_TABLE``.
CRC_TABLE = """tab as (select list(c order by i) as t from (
            select i, list_reduce([i] || range(8), lambda c, x: case when c & 1 = 1 then xor(3988292384::bigint, c >> 1) else c >> 1 end) as c from range(256) r(i)))"""
CRC = "xor(list_reduce([4294967295::bigint] || {bytes}, lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::bigint)"


def _plus(cost: int | str, way: str, letter: str) -> str:
    """SQL for a way of edits, its cost in six digits and its letters, with one edit put in front."""
    return f"lpad((left({way}, 6)::int + {cost})::varchar, 6, '0') || '{letter}' || substr({way}, 7)"


def _ways(state: int, kept: str, to: int) -> str:
    """SQL for the cheapest way from ``state`` over a row, without an insertion before it."""
    ways = [_plus(3, f"e{state}", "D"), f"case when sign <> 'x' then {_plus('2 + cut', f'e{to}', 'R')} end",
            *[f"case when sign = '{sign}' then {_plus('cut', f'e{after}', 'K')} end" for sign, after in (k.split(":") for k in kept.split())]]
    return f"least({', '.join(ways)}) as b{state}"

ORACLE: dict[str, str] = {
    "op3_arc_to_warc": """
        with p as (select page_id, strlen(coalesce(html, '')) as n, sha256(coalesce(html, '')) as d from pages),
        f as (select d, min(page_id) as first from p group by d)
        select page_id, n::bigint as payload_bytes, d as payload_digest,
               case when n >= 100 and first < page_id then 'revisit' else 'response' end as record_type,
               case when n >= 100 and first < page_id then first end as refers_to
        from p join f using (d)""",
    "op4_jaccard_join": """
        with recursive words as (
            select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                          '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
        sets as (
            select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
                   else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as s from words),
        sizes as (select doc_id, len(s)::bigint as n from sets),
        items as (select doc_id, unnest(s) as s from sets),
        common as (select a.doc_id as a, b.doc_id as b, count(*) as c from items a join items b on a.s = b.s and a.doc_id < b.doc_id group by all),
        links as (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 90 * (x.n + y.n - c)),
        sides as (select a, b from links union all select b, a from links),
        reach(node, root) as (select doc_id, doc_id from documents union select sides.b, reach.root from reach join sides on sides.a = reach.node)
        select doc_id, n as n_shingles, (select min(root) from reach where node = doc_id) as component_id from sizes""",
    "op6_passages": """
        with words as (
            select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
        starts as (select doc_id, unnest(range(1, len(w) - 48)) as p from words where len(w) >= 50),
        windows as (select doc_id, p, array_to_string(w[p:p + 49], ' ') as t from starts join words using (doc_id)),
        firsts as (select t, min(doc_id) as first from windows group by t),
        gone as (select doc_id, p from windows join firsts using (t) where first < doc_id),
        places as (select doc_id, unnest(range(1, len(w) + 1)) as p, unnest(w) as word from words),
        marked as (
            select doc_id, p, word, max(case when gone.p is not null then 1 else 0 end)
                   over (partition by doc_id order by p rows between 49 preceding and current row) as hit
            from places left join gone using (doc_id, p)),
        kept as (
            select doc_id, count(*) as n_words, sum(hit) as n_removed, coalesce(string_agg(word, ' ' order by p) filter (hit = 0), '') as t
            from marked group by doc_id)
        select doc_id, coalesce(n_words, 0)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
        from documents left join kept using (doc_id)""",
    "op2_decontamination": """
        with dw as (select doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') as w from documents),
        iw as (select item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') as w from benchmark),
        ds as (select doc_id, unnest(range(0, len(w) - 4)) as place,
                      unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) as s from dw where len(w) >= 5),
        sizes as (select doc_id, len(w) - 4 as n from dw),
        bag as (select item_id, len(w) - 4 as m, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) as s
                from iw where len(w) >= 5),
        counts as (select item_id, m, s, count(*) as c from bag group by all),
        hits as (select doc_id, item_id, m, place, s, c from ds join counts using (s)),
        starts as (select distinct doc_id, item_id, m, unnest(range(greatest(0, place - m + 1), place + 1)) as start from hits),
        inside as (select t.doc_id, t.item_id, t.m, t.start, h.s, any_value(h.c) as c, count(*) as n
                   from starts t join sizes z on z.doc_id = t.doc_id and t.start + t.m <= z.n
                   join hits h on h.doc_id = t.doc_id and h.item_id = t.item_id and h.place >= t.start and h.place < t.start + t.m group by all),
        scored as (select doc_id, item_id, m, start, sum(least(c, n)) as matched from inside group by all),
        best as (select doc_id, item_id, any_value(m) as m, max(matched) as matched, arg_min(start, (-matched, start)) as start
                 from scored where 10 * matched >= 8 * (2 * m - matched) group by all)
        select doc_id, item_id, start::int as start, matched::int as matched, m::int as n_shingles, matched::double / (2 * m - matched) as similarity from best""",
    "op8_quotation_links": """
        with recursive said as (select conv_id, turn, role, coalesce(text, '') as t from conversations),
        own as (select conv_id, turn, unnest(string_split(t, chr(10))) as line from said),
        normal as (select conv_id, turn, lower(trim(regexp_replace(line, '\\s+', ' ', 'g'))) as norm from own),
        first as (select conv_id, norm, min(turn) as origin from normal where norm <> '' group by all),
        quoted as (select conv_id, turn + 1 as turn, 1 as level, norm from normal union all select conv_id, turn + 2, 2, norm from normal),
        lines as (select q.conv_id, q.turn, q.norm, min(level) as level from quoted q join said m on m.conv_id = q.conv_id and m.turn = q.turn
                  where norm <> '' group by all),
        found as (select l.conv_id, l.turn, l.level, f.origin from lines l left join first f on f.conv_id = l.conv_id and f.norm = l.norm and f.origin < l.turn),
        parents as (select conv_id, turn, count(*) as n_quoted, count(origin) as n_linked,
                           arg_max(origin, (-level, origin)) filter (origin is not null) as parent_turn from found group by all),
        paths(conv_id, turn, root, depth) as (
            select s.conv_id, s.turn, s.turn, 0 from said s left join parents p using (conv_id, turn) where p.parent_turn is null
            union all select p.conv_id, p.turn, paths.root, paths.depth + 1 from paths join parents p on p.conv_id = paths.conv_id and p.parent_turn = paths.turn)
        select s.conv_id, s.turn, s.role, p.parent_turn, paths.root as thread_root, paths.depth::int as depth,
               coalesce(p.n_quoted, 0)::bigint as n_quoted, coalesce(p.n_linked, 0)::bigint as n_linked,
               regexp_replace(s.t, '^\\s+|\\s+$', '', 'g') as body
        from said s join paths using (conv_id, turn) left join parents p using (conv_id, turn)""",
    "op11_conversation_repair": f"""
        with recursive {CRC_TABLE},
        src as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
                       coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
        hit as (select conv_id, turn, role, text, {CRC.format(bytes="list_transform(range(length(k)), lambda i: ascii(substr(k, i + 1, 1))::bigint)")} % 20 as f from src, tab),
        damaged as (select conv_id, turn, case when f = 4 then 'user' else role end as role,
                           case f when 1 then '' when 2 then translate(text, '.!?', '') else text end as text, case f when 0 then 0 when 3 then 2 else 1 end as n from hit),
        copies as (select conv_id, turn, role, text, unnest(range(n)) as copy from damaged),
        placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(length(role) || ':' || role || text), copy) as p from copies),
        facts as (select *, left(role, 1) as initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body,
                         lag(left(role, 1)) over (partition by conv_id order by p) as before, row_number() over (partition by conv_id, role, text order by p) > 1 as seen from placed),
        judged as (select *, case when body = '' then 'b' when seen then 'd' when right(body, 1) not in ('.', '!', '?') then 't' else '-' end as fault from facts),
        line as (select conv_id, p, role, text, case when fault in ('b', 'd') then 'x' when initial in ('s', 'u', 'a') then initial else 'o' end as sign,
                        (fault = 't')::int as cut from judged),
        sums as (select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'b') as blank,
                        count(*) filter (fault = 'd') as duplicate, count(*) filter (fault = 't') as truncated,
                        count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal from judged group by conv_id),
        ways(conv_id, p, e0, e1, e2, e3) as (
            select conv_id, n + 1, '000000', '000004II', '000002I', '000000' from sums
            union all
            select conv_id, p, least(b0, {_plus(2, "c2", "I")}), least(b1, {_plus(2, "c2", "I")}), c2, least(b3, {_plus(2, "b2", "I")}) from (
                select *, least(b2, {_plus(2, "b3", "I")}) as c2 from (
                    select l.conv_id, l.p, {_ways(0, "s:1 u:2", 2)}, {_ways(1, "u:2", 2)}, {_ways(2, "a:3", 3)}, {_ways(3, "u:2", 2)}
                    from ways w join line l on l.conv_id is not distinct from w.conv_id and l.p = w.p - 1))),
        best as (select conv_id, left(e0, 6)::bigint as cost, substr(e0, 7) as audit from ways where p = 1),
        walk(conv_id, audit, i, p, state, role, text) as (
            select conv_id, audit, 0, 0::bigint, 0, null::varchar, null::varchar from best
            union all
            select conv_id, audit, i + 1, here, case when letter = 'D' then state when letter = 'K' then kept else to_ end,
                   case when letter = 'K' then role when letter <> 'D' then case to_ when 2 then 'user' else 'assistant' end end,
                   case when letter = 'I' then '' when letter <> 'D' then text end
            from (select w.conv_id, w.audit, w.i, w.state, substr(w.audit, w.i + 1, 1) as letter, case when w.state = 2 then 3 else 2 end as to_, l.role, l.text,
                         case when substr(w.audit, w.i + 1, 1) = 'I' then w.p else w.p + 1 end as here, case left(l.role, 1) when 's' then 1 when 'u' then 2 else 3 end as kept
                  from walk w left join line l on l.conv_id is not distinct from w.conv_id and l.p = w.p + 1 where w.i < length(w.audit))),
        repaired as (select conv_id, string_agg(role || ':' || text, chr(10) order by i) as t from walk where role is not null group by conv_id),
        ids as (select distinct conv_id from conversations)
        select i.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
               coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit,
               sha256(coalesce(t, '')) as repaired_sha256
        from ids i left join sums s on s.conv_id is not distinct from i.conv_id left join best b on b.conv_id is not distinct from i.conv_id
        left join repaired r on r.conv_id is not distinct from i.conv_id""",
    "op13_spelling_variants": f"""
        with recursive {CRC_TABLE},
        runs as (select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as w
                 from documents),
        counted as (select coalesce(doc_id::varchar, '') || ':' || w as k, w, count(*) as c from runs group by all),
        coded as (select w, c, hex(encode(k)) as x from counted),
        summed as (select w, c, {CRC.format(bytes="list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::bigint)")} as h from coded, tab),
        kept as (select case when h % 199 = 0 then left(w, h % length(w)) || substr(w, h % length(w) + 2) else w end as word, c from summed),
        words as (select word, sum(c)::bigint as n from kept where length(word) >= 6 group by word having sum(c) >= 5),
        cuts as (select word, n, i, left(word, i - 1) || substr(word, i + 1) as d from words, lateral (select unnest(range(1, length(word) + 1)) as i)),
        pairs as (select a.word, b.word as near, b.n from cuts a join cuts b on a.d = b.d and a.i = b.i and a.word <> b.word
                  union select a.word, b.word, b.n from cuts a join words b on a.d = b.word
                  union select b.word, a.word, a.n from cuts a join words b on a.d = b.word),
        best as (select word, count(*) as n_near, arg_min(near, (-n, near)) as near, max(n) as m from pairs group by word),
        forms as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when m >= 5 * w.n then near end as form, case when m >= 5 * w.n then m end as form_n
                  from words w left join best using (word)),
        follow(word, at_) as (select word, word from forms union all select f.word, g.form from follow f join forms g on g.word = f.at_ where g.form is not null)
        select f.word, f.form, r.root, f.n, f.n_near, f.form_n
        from forms f join (select word, at_ as root from follow join (select word as w2 from forms where form is null) on at_ = w2) r using (word)""",
}

"""SQL counterparts, written from the definitions for an engine that holds all windows."""

from __future__ import annotations

ORACLES = {
    "op5_suffix_dedup": """
        with d as (
            select doc_id, hex(encode(coalesce(text, ''))) as h,
                   octet_length(encode(coalesce(text, ''))) as n
            from documents),
        w as (
            select doc_id, i, md5(substr(h, 2 * i + 1, 200)) as k
            from d, unnest(range(0, n - 99)) as u(i)),
        later as (
            select doc_id, i from (
                select *, row_number() over (partition by k order by doc_id, i) as r from w)
            where r > 1),
        marked as (
            select *, case when i <= lag(i) over (partition by doc_id order by i) + 100
                           then 0 else 1 end as head
            from later),
        runs as (
            select doc_id, min(i) as a, max(i) + 100 as b from (
                select *, sum(head) over (partition by doc_id order by i
                    rows between unbounded preceding and current row) as run from marked)
            group by doc_id, run),
        gone as (
            select doc_id, count(*) as n_spans, sum(b - a) as n_removed from runs
            group by doc_id),
        edges as (
            select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) as since,
                   a as until from runs
            union all
            select d.doc_id, coalesce(max(b), 0), any_value(d.n)
            from d left join runs on runs.doc_id = d.doc_id group by d.doc_id),
        kept as (
            select e.doc_id, string_agg(substr(h, 2 * since + 1, 2 * (until - since)), ''
                                        order by since, until) as rest
            from edges e join d on d.doc_id = e.doc_id group by e.doc_id)
        select d.doc_id, d.n as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
               coalesce(n_spans, 0) as n_spans, sha256(unhex(rest)) as kept_sha256
        from d join kept on kept.doc_id = d.doc_id left join gone on gone.doc_id = d.doc_id""",
    "op7_line_dedup": """
        with d as (
            select doc_id, text, string_split(coalesce(text, ''), chr(10)) as ls
            from documents),
        l as (
            select doc_id, i as pos, ls[i] as raw, trim(ls[i], ' ' || chr(9) || chr(13)) as t
            from d, unnest(range(1, len(ls) + 1)) as u(i)),
        f as (
            select *, row_number() over (partition by doc_id order by pos) as r
            from l where t <> ''),
        w as (
            select a.doc_id, a.pos as a1, b.pos as a2, c.pos as a3,
                   row_number() over (partition by a.t, b.t, c.t order by a.doc_id, a.pos) as n
            from f a join f b on b.doc_id = a.doc_id and b.r = a.r + 1
                     join f c on c.doc_id = a.doc_id and c.r = a.r + 2),
        gone as (
            select distinct doc_id, unnest([a1, a2, a3]) as pos from w where n > 1),
        kept as (
            select doc_id, string_agg(raw, chr(10) order by pos) as rest
            from l where not exists (
                select 1 from gone where gone.doc_id = l.doc_id and gone.pos = l.pos)
            group by doc_id),
        counted as (select doc_id, count(*) as n from gone group by doc_id)
        select d.doc_id, cast(case when text is null then 0 else len(ls) end as bigint) as n_lines,
               coalesce(counted.n, 0) as n_removed,
               sha256(coalesce(rest, '')) as kept_sha256
        from d left join kept on kept.doc_id = d.doc_id
               left join counted on counted.doc_id = d.doc_id""",
    "op11_merkle_manifest": """
        with recursive
        hits as (
            select doc_id, list_reduce(
                list_prepend(4294967295::bigint,
                    list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
                lambda crc, byte: list_reduce(
                    list_prepend(xor(crc, byte), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
                    lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384::bigint)
                                   else x >> 1 end)) as crc
            from (select distinct doc_id from documents)),
        fields as (
            select d.doc_id, lang, n_chars,
                   coalesce(strlen(d.doc_id::varchar) || ':' || d.doc_id, '-')
                   || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') as head,
                   coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as mid,
                   case when n_chars is null then '-' else
                       strlen((n_chars::hugeint + 1)::varchar) || ':' || (n_chars::hugeint + 1)
                   end as longer,
                   coalesce(strlen(text) || ':' || text, '-') as tail,
                   xor(crc, 4294967295::bigint) % 7 = 0 as hit
            from documents d left join hits on hits.doc_id = d.doc_id),
        leaves as (
            select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1
                      as pos
            from (select doc_id, lang, sha256(head || mid || tail) as leaf,
                         case when hit then sha256(head || longer || tail) end as other
                  from fields)),
        langs as (
            select lang, count(*) as n, row_number() over (order by lang nulls first) - 1 as place
            from leaves group by lang),
        low as (
            select place, 0 as lvl, pos, leaf as node, n
            from leaves join langs on langs.lang is not distinct from leaves.lang
            union all
            select place, any_value(lvl) + 1, pos // 2, sha256(string_agg(node, '' order by pos)),
                   (any_value(n) + 1) // 2
            from low where n > 1 group by place, pos // 2),
        high as (
            select 0 as lvl, place as pos, node, (select count(*) from langs) as n
            from low where n = 1
            union all
            select any_value(lvl) + 1, pos // 2, sha256(string_agg(node, '' order by pos)),
                   (any_value(n) + 1) // 2
            from high where n > 1 group by pos // 2),
        climb as (
            select doc_id, leaf, place, 0 as stage, 0 as lvl, pos, n, langs.place as home,
                   coalesce(other, leaf) as node, '' as proof
            from leaves join langs on langs.lang is not distinct from leaves.lang
            union all
            select c.doc_id, c.leaf, c.place,
                   case when c.n = 1 then 1 else c.stage end,
                   case when c.n = 1 then 0 else c.lvl + 1 end,
                   case when c.n = 1 then c.home else c.pos // 2 end,
                   case when c.n = 1 then (select count(*) from langs) else (c.n + 1) // 2 end,
                   c.home,
                   case when c.n = 1 then c.node
                        when c.pos % 2 = 1 then sha256(s.node || c.node)
                        else sha256(c.node || coalesce(s.node, '')) end,
                   c.proof || coalesce(s.node, '')
            from climb c left join (
                select 0 as stage, place, lvl, pos, node from low
                union all select 1, null, lvl, pos, node from high) s
                on c.n > 1 and s.stage = c.stage and s.lvl = c.lvl
                   and s.pos = xor(c.pos, 1::bigint)
                   and (c.stage = 1 or s.place = c.place)
            where c.stage = 0 or c.n > 1)
        select doc_id, leaf, sub.node as subroot, root.node as root,
               sha256(proof) as proof_sha256, climb.node as folded_root,
               climb.node = root.node as verified
        from climb join low sub on sub.place = climb.home and sub.n = 1
             join high root on root.n = 1
        where climb.stage = 1 and climb.n = 1""",
    "op12_collocations": r"""
        with p as (
            select row_number() over () as piece, lang, w
            from (
                select coalesce(lang, 'und') as lang, unnest(string_split_regex(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[.,;:!?\n\x0B\f\r]')) as t
                from documents where text is not null)
            cross join lateral (select regexp_extract_all(t, '[^ \t]+') as w)),
        n as (select lang, sum(len(w))::bigint as n from p group by lang),
        c as (
            select lang, m, array_to_string(w[i:i + m - 1], ' ') as phrase, count(*) as f
            from p, unnest([1, 2, 3, 4]) as s(m), unnest(range(1, len(w) - m + 2)) as u(i)
            group by all having count(*) >= 30),
        x as (select *, string_split(phrase, ' ') as w from c where m > 1),
        cuts as (
            select x.lang, x.phrase, x.f as a, k, h.f as l, t.f as r,
                   (2000000::hugeint * x.f // (h.f + t.f))::bigint as score
            from x, unnest(range(1, m)) as u(k)
            join c h on h.lang = x.lang and h.phrase = array_to_string(w[:k], ' ')
            join c t on t.lang = x.lang and t.phrase = array_to_string(w[k + 1:], ' ')),
        best as (
            select * from cuts
            qualify row_number() over (partition by lang, phrase order by score, k) = 1),
        inside as (
            select lang, array_to_string(w[i:i + s - 1], ' ') as phrase, max(f) as longest
            from x, unnest(range(2, m)) as v(s), unnest(range(1, m - s + 2)) as u(i)
            group by all),
        ranked as (
            select best.*, row_number() over (
                partition by best.lang order by score desc, a desc, best.phrase) as rank
            from best left join inside
                on inside.lang = best.lang and inside.phrase = best.phrase
            where longest is null or 100::hugeint * longest < 80::hugeint * a)
        select ranked.lang, rank, phrase, a, l, r, n, score
        from ranked join n on n.lang = ranked.lang where rank <= 2000""",
    "op13_minhash": r"""
        with recursive
        d as (
            select doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^ \t\n\x0B\f\r]+') as w
            from documents),
        s as (
            select doc_id, list_distinct(case
                when coalesce(len(w), 0) = 0 then [] when len(w) = 1 then w
                else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
                end) as set
            from d),
        sets as (select set, any_value(doc_id) as id, min(doc_id) as least, len(set) as n
                 from (select doc_id, list_sort(set) as set from s where len(set) > 0)
                 group by set),
        t as (select id, n, unnest(set) as token from sets),
        pairs as (
            select a.id as a, b.id as b
            from t a join t b on a.token = b.token and a.id < b.id
                 and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
            group by a.id, b.id, a.n, b.n
            having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        edges as (select a, b from pairs union select b, a from pairs),
        reach as (
            select id as node, id as other from sets
            union
            select reach.node, edges.b from reach join edges on edges.a = reach.other),
        comp as (
            select node, min(least) as component_id
            from reach join sets on sets.id = reach.other group by node)
        select s.doc_id, len(s.set) as n_shingles,
               coalesce(component_id, s.doc_id) as component_id,
               s.doc_id is not distinct from coalesce(component_id, s.doc_id) as kept
        from s left join sets on sets.set = list_sort(s.set) left join comp on comp.node = sets.id""",
}

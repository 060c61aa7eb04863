"""DuckDB equivalents of the queries that SQL can express."""

SQL = {
    "op5_exact_dedup": r"""
        with digests as (
            select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
            from documents
        ),
        ranked as (
            select *, row_number() over (partition by text_sha256 order by doc_id nulls last) as place,
                min(doc_id) over (partition by text_sha256) as keep_id,
                count(*) over (partition by text_sha256) as group_size
            from digests
        )
        select doc_id, keep_id, group_size, place = 1 as kept, text_sha256 from ranked
    """,
    # The weights are those of mixing.py's defaults: 98 % of the greatest entropy,
    # at most 2 rounds, 1024 blocks, 50 halvings.
    "op9_mixing": r"""
        with recursive docs as (
            select doc_id, coalesce(source, '') as source,
                len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) + 1 as n_tokens,
                ('0x' || md5('block:' || coalesce(doc_id::varchar, 'null'))[1:7])::bigint % 1024 as block
            from documents
        ),
        shares as (
            select source, sum(n_tokens)::bigint as tokens,
                sum(n_tokens) / (select sum(n_tokens) from docs) as p, count(*) over () as n
            from docs group by source
        ),
        halvings as (
            select 0 as step, 0.0::double as e_low, 1.0::double as e_high, 0.0::double as r_low, 1.0::double as r_high
            union all
            select step + 1, if(e_met, e_mid, e_low), if(e_met, e_high, e_mid), if(r_met, r_mid, r_low), if(r_met, r_high, r_mid)
            from (
                select *, (e_low + e_high) / 2 as e_mid, (r_low + r_high) / 2 as r_mid,
                    (select -sum(w * ln(w)) >= 0.98 * ln(any_value(n))
                     from (select n, p ** ((e_low + e_high) / 2) / sum(p ** ((e_low + e_high) / 2)) over () as w from shares)) as e_met,
                    (select max(p ** ((r_low + r_high) / 2 - 1)) / min(p ** ((r_low + r_high) / 2 - 1)) > 2.0 from shares) as r_met
                from halvings where step < 50
            )
        ),
        chosen as (
            select round(greatest(
                case when (select -sum(p * ln(p)) >= 0.98 * ln(any_value(n)) from shares) then 1.0 else e_low end,
                case when (select max(1 / p) / min(1 / p) <= 2.0 from shares) then 0.0 else r_low end
            ), 9) as x
            from halvings where step = 50
        ),
        figures as (
            select source, tokens, x, p ** x / sum(p ** x) over () as weight,
                p ** (x - 1) / min(p ** (x - 1)) over () as repeats
            from shares, chosen
        ),
        blocks as (
            select source, block, sum(n_tokens) as tokens from docs group by all
        ),
        ordered as (
            select b.source, b.block, f.tokens as source_tokens, weight, repeats, x,
                sum(b.tokens) over (
                    partition by b.source
                    order by ('0x' || md5('order:' || floor(repeats)::bigint || ':' || b.source || ':' || b.block)[1:7])::bigint, b.block
                ) as so_far
            from blocks b join figures f using (source)
        )
        select doc_id, source, n_tokens::bigint as n_tokens, block,
            (floor(repeats) + if(so_far <= round((repeats - floor(repeats)) * source_tokens), 1, 0))::bigint as copies,
            source_tokens, round(weight, 6) as weight, round(repeats, 6) as repeats, round(x, 6) as exponent
        from docs join ordered using (source, block)
    """,
    "op13_collocations": r"""
        with pieces as (
            select coalesce(lang, 'und') as lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) as piece
            from documents
        ),
        word_lists as (
            select row_number() over () as id, lang,
                list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') as ws
            from pieces
        ),
        words as (select id, lang, generate_subscripts(ws, 1) as i, unnest(ws) as w from word_lists),
        sizes as (select lang, count(*) as n from words group by lang),
        following as (
            select lang, w as w1, lead(w, 1) over piece as w2, lead(w, 2) over piece as w3, lead(w, 3) over piece as w4
            from words window piece as (partition by id order by i)
        ),
        phrases as (
            select lang, k, [w1, w1 || ' ' || w2, w1 || ' ' || w2 || ' ' || w3, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4][k] as phrase
            from following, (values (1), (2), (3), (4)) ks(k)
            where phrase is not null
        ),
        frequent as (select lang, k, phrase, count(*) as a from phrases group by all having count(*) >= 30),
        candidates as (select *, string_split(phrase, ' ') as ws from frequent where k > 1),
        cuts as (
            select lang, phrase, c.k, a, ws, cut, array_to_string(ws[1:cut], ' ') as head, array_to_string(ws[cut + 1:], ' ') as tail
            from candidates c, (values (1), (2), (3)) cuts(cut)
            where cut < c.k
        ),
        scored as (
            select c.lang, c.phrase, c.a, cut, h.a as l, t.a as r,
                (2000000::hugeint * c.a // (h.a + t.a))::bigint as score
            from cuts c
            join frequent h on h.lang = c.lang and h.phrase = c.head
            join frequent t on t.lang = c.lang and t.phrase = c.tail
        ),
        lowest as (
            select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1
        ),
        inner_phrases as (
            select distinct lang, a, array_to_string(ws[i : i + size - 1], ' ') as phrase
            from candidates, (values (2), (3)) sizes(size), (values (1), (2), (3)) starts(i)
            where size < k and i + size - 1 <= k
        ),
        free as (
            select * from lowest w
            where not exists (
                select 1 from inner_phrases p
                where p.lang = w.lang and p.phrase = w.phrase and 100 * p.a >= 80 * w.a
            )
        ),
        ranked as (
            select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from free
        )
        select lang, rank, phrase, a, l, r, n, score from ranked join sizes using (lang) where rank <= 2000
    """,
}

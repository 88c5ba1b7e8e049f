"""DuckDB SQL with the results of the corpus queries that SQL can express."""

from __future__ import annotations

SPACE = r"[\x20\x09-\x0D]+"


def escaped(column: str) -> str:
    return rf"regexp_replace({column}, '([<\[\\])', '\1\\', 'g')"


SPLIT = r"""
    select {id} as id, list_filter(regexp_split_to_array(lower(coalesce(text, '')),
                                                         '[^\p{{L}}\p{{N}}]+'),
                                   lambda x: x <> '') as w
    from {table}
"""

# Items of fewer than five words are one shingle of their length.
OP2 = f"""
    with i_words as ({SPLIT.format(id="item_id", table="benchmark")}),
    d_words as ({SPLIT.format(id="doc_id", table="documents")}),
    items as (
        select id, least(len(w), 5) as k, unnest(list_distinct(list_transform(
            range(1, len(w) - least(len(w), 5) + 2),
            lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' ')))) as g
        from i_words where len(w) > 0
    ),
    docs as (
        select id, k, unnest(list_distinct(list_transform(range(1, len(w) - k + 2),
            lambda i: array_to_string(w[i:i + k - 1], ' ')))) as g
        from d_words, (select distinct k from items) where len(w) >= k
    ),
    sizes as (select id, count(*) as n_item from items group by id)
    select d.id as doc_id, i.id as item_id, count(*) as n_hits, n_item
    from docs d join items i on d.g = i.g and d.k = i.k join sizes s on s.id = i.id
    group by d.id, i.id, n_item
    having 100 * count(*) >= 80 * n_item
"""

# Every turn costs the three marks (8 + 8 + 7 characters).
OP7 = f"""
    with turns as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
        from conversations
        union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
        union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
    )
    select conv_id, count(*) as n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text))
               as turns_sha256,
           coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
           sha256(coalesce(string_agg(text, '' order by turn, role, text)
                           filter (where role = 'assistant'), '')) as loss_sha256,
           sum(23 + length({escaped("role")}) + length({escaped("text")}))::bigint
               as formatted_chars
    from turns group by conv_id
"""

OP8 = rf"""
    with split as (
        select doc_id, source, coalesce(text, '') as body,
               list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'), lambda x: x <> '') as w,
               list_filter(string_split(coalesce(text, ''), chr(10)),
                           lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
        from documents
    ), windows as (
        select doc_id, i, count(*) over (partition by doc_id, g) as n
        from (
            select doc_id, unnest(range(1, len(w) - 1)) as i,
                   unnest(list_transform(range(1, len(w) - 1),
                          lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as g
            from split
        )
    ), repeats as (
        select doc_id, count(distinct p) as n from (
            select doc_id, unnest([i, i + 1, i + 2]) as p from windows where n >= 2
        ) group by doc_id
    ), counts as (
        select s.doc_id, source, len(w)::bigint as n_words,
               length(list_aggregate(w, 'string_agg', ''))::bigint as chars,
               len(regexp_extract_all(body, '[#*$%&|<>]'))::bigint as n_symbols,
               len(l)::bigint as n_lines,
               (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
               coalesce(r.n, 0)::bigint as n_repeat_words
        from split s left join repeats r on s.doc_id = r.doc_id
    ), judged as (
        select *, coalesce(chars, 0) as word_chars,
               n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
               base_failed or 100 * n_symbols > 10 * coalesce(chars, 0)
                   or 100 * n_dup_lines > 50 * n_lines as failed
        from counts
    ), hosts as (
        select source, count(*)::double as n, sum(failed::int)::double as f
        from judged where source is not null group by source
    ), moments as (
        select count(*) as k, sum(n) as nn, sum(f) / sum(n) as m,
               sum(f * f / n) - sum(f) * sum(f) / sum(n) as chance,
               sum(n) - sum(n * n) / sum(n) - (count(*) - 1) as room
        from hosts
    ), prior as (
        select m, 1 / greatest(0.001, least(0.5, case when m > 0 and m < 1 and room > 0
            then (chance / (m * (1 - m)) - (k - 1)) / room else 0.5 end)) - 1 as strength
        from moments
    ), rejected as (
        select source from hosts, prior
        where (f + m * strength) / (n + strength) > 0.75 and n >= 20
    )
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           not base_failed and r.source is null as kept, failed,
           r.source is not null as host_rejected
    from judged j left join rejected r on j.source = r.source
"""

OP10 = r"""
    with parts as (
        select page_id,
               translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
               coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
        from pages
    ), rules(rule_host, rule_path, rule_verdict) as (
        values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
               ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
    ), fits as (
        select page_id, host, path, rule_host || rule_path as rule, rule_verdict,
               row_number() over (partition by page_id
                                  order by length(rule_host || rule_path) desc nulls last) as nth
        from parts left join rules
          on (host = rule_host or ends_with(host, '.' || rule_host))
             and starts_with(path, rule_path)
    )
    select page_id, host, path, rule, coalesce(rule_verdict, 'allow') as verdict
    from fits where nth = 1
"""

OP12 = """
    with texts as (select doc_id, coalesce(text, '') as text from documents)
    select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
           row_number() over (same order by doc_id desc) = 1 as kept, sha256(text) as text_sha256
    from texts window same as (partition by text)
"""

OP13 = r"""
    with pieces as (
        select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
        from documents
    ), split as (
        select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'),
                                 lambda x: x <> '') as w
        from pieces
    ), totals as (
        select lang, sum(len(w))::hugeint as n from split group by lang
    ), grams as (
        select lang, k, unnest(list_transform(range(1, len(w) - k + 2),
                                              lambda i: w[i:i + k - 1])) as p
        from split, range(1, 6) t(k) where len(w) >= k
    ), counts as (
        select lang, k, p, count(*)::hugeint as f from grams group by lang, k, p
        having count(*) >= 100
    ), inner_parts as (
        select lang, p[1:k - 1] as p, f from counts where k >= 3
        union all select lang, p[2:k] as p, f from counts where k >= 3
    ), stay as (
        select * from counts c where k >= 2 and not exists (
            select 1 from inner_parts i where i.lang = c.lang and i.p = c.p and i.f >= c.f)
    ), cuts as (
        select s.lang, s.p, s.f as a, cut, x.f as l, y.f as r, t.n,
               (1000 * s.f * t.n) // (x.f * y.f) as score
        from (select *, unnest(range(1, k)) as cut from stay) s
        join counts x on x.lang = s.lang and x.p = s.p[1:cut]
        join counts y on y.lang = s.lang and y.p = s.p[cut + 1:s.k]
        join totals t on t.lang = s.lang
    ), lowest as (
        select *, row_number() over (partition by lang, p order by score, cut) as nth from cuts
    ), ranked as (
        select *, array_to_string(p, ' ') as phrase, row_number() over (
            partition by lang order by score desc, a desc, array_to_string(p, ' ')) as rank
        from lowest where nth = 1
    )
    select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n,
           score::bigint as score
    from ranked where rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op2_decontaminate": OP2,
    "op7_chat": OP7,
    "op8_quality_rules": OP8,
    "op10_url_filter": OP10,
    "op12_exact_dedup": OP12,
    "op13_collocations": OP13,
}

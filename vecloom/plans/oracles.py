"""DuckDB SQL with the result of each query that SQL can express, on the same tables."""

from __future__ import annotations

# One row per value of each vector, positions from 0.
VALUES = """
    select vec_id, label, unnest(generate_series(0, len(embedding) - 1)) as dim,
           unnest(embedding)::double as v
    from embeddings
"""

# The same, standardised by column; constant columns become 0.
SCALED = f"""
    select vec_id, dim, case when sd = 0 then 0.0 else (v - mean) / sd end as z
    from (
        select vec_id, dim, v, avg(v) over (partition by dim) as mean,
               stddev_samp(v) over (partition by dim) as sd
        from ({VALUES})
    )
"""

CORRELATION = f"""
    select a.dim as i, b.dim as j, corr(a.v, b.v) as r
    from ({VALUES}) a join ({VALUES}) b on a.vec_id = b.vec_id
    group by a.dim, b.dim
"""

# Eigenvalues and axes of the correlation matrix (64 x 64, as lists of 4,096): ten sweeps of plane
# rotations, 32 disjoint pairs of columns at a time. p is each column's partner in the turn, t the
# tangent of the angle that clears the pair's cell, c and d the cosine and (signed) sine.
AXES = f"""
    with recursive turns as (
        select 0 as step, list(r order by i, j) as a,
               list_transform(range(4096), lambda x: (x // 64 = x % 64)::int::double) as v
        from ({CORRELATION})
        union all
        select step + 1,
               list_transform(range(4096), lambda x:
                   c[x // 64 + 1] * (c[x % 64 + 1] * a[x + 1]
                                     + d[x % 64 + 1] * a[x - x % 64 + p[x % 64 + 1] + 1])
                   + d[x // 64 + 1] * (c[x % 64 + 1] * a[p[x // 64 + 1] * 64 + x % 64 + 1]
                                       + d[x % 64 + 1]
                                         * a[p[x // 64 + 1] * 64 + p[x % 64 + 1] + 1])),
               list_transform(range(4096), lambda x:
                   c[x % 64 + 1] * v[x + 1] + d[x % 64 + 1] * v[x - x % 64 + p[x % 64 + 1] + 1])
        from (
            select *, list_transform(t, lambda x: 1 / sqrt(1 + x * x)) as c,
                   list_transform(t, lambda x: x / sqrt(1 + x * x)) as d
            from (
                select *, list_transform(range(64), lambda i:
                    case when a[i * 64 + p[i + 1] + 1] = 0 then 0.0
                         else -2 * a[i * 64 + p[i + 1] + 1]
                              * (case when a[p[i + 1] * 65 + 1] > a[i * 65 + 1]
                                        or (a[p[i + 1] * 65 + 1] = a[i * 65 + 1]
                                            and i < p[i + 1]) then 1 else -1 end)
                              / (abs(a[p[i + 1] * 65 + 1] - a[i * 65 + 1])
                                 + sqrt((a[p[i + 1] * 65 + 1] - a[i * 65 + 1]) ** 2
                                        + 4 * a[i * 64 + p[i + 1] + 1] ** 2))
                    end) as t
                from (
                    select step, a, v, list_transform(range(64), lambda i:
                        case when i = 63 then step % 63
                             when i = step % 63 then 63
                             else (2 * (step % 63) - i + 63) % 63 end) as p
                    from turns where step < 630
                )
            )
        )
    )
    select row_number() over (order by value desc) - 1 as component, value,
           list_transform(axis, lambda w: w * sign(list_max(axis) + list_min(axis))) as axis
    from (
        select a[j * 65 + 1] as value,
               list_transform(range(64), lambda i: v[i * 64 + j + 1]) as axis
        from (select a, v, unnest(range(64)) as j from turns where step = 630)
    )
"""

CURVE = f"""
    select component + 1 as k, value / sum(value) over () as ratio,
           sum(value) over (order by component) / sum(value) over () as cumulative
    from ({AXES})
"""

# Grey levels as the image files are made from the vectors.
GRAY = f"""
    select vec_id, label, dim, greatest(0, least(126, floor((v + 1) * 63)::int)) as g
    from ({VALUES})
"""

COLORS = f"""
    select vec_id, label, dim, unnest([0, 1, 2]) as channel, unnest([g, g // 2, 127 - g]) as level
    from ({GRAY})
"""

CHANNEL_TOTALS = f"""
    select 'Classe=' || label as "Classe", channel, count(*) as n, sum(top)::bigint as total
    from (
        select vec_id, label, channel, max(level) as top from ({COLORS})
        group by vec_id, label, channel
    )
    group by label, channel
"""

# Scores by class of (quality, toxic).
PAIRS = """(
    select doc_id, quality, toxic from labels where quality is not null and toxic is not null
)"""

PER_LABEL = f"""
    select label, support, predicted, tp,
           case when total = support then 0.0
                else (predicted - tp)::double / (total - support) end as fpr,
           recall as tpr, precision, recall,
           case when precision + recall = 0 then 0.0
                else 2 * precision * recall / (precision + recall) end as f1
    from (
        select *, case when support = 0 then 0.0 else tp::double / support end as recall,
               case when predicted = 0 then 0.0 else tp::double / predicted end as precision
        from (
            select c.label, (select count(*) from {PAIRS}) as total,
                   count(*) filter (where l.quality = c.label) as support,
                   count(*) filter (where l.toxic = c.label) as predicted,
                   count(*) filter (where l.quality = c.label and l.toxic = c.label) as tp
            from (select quality as label from {PAIRS} union select toxic from {PAIRS}) c
            join {PAIRS} l on l.quality = c.label or l.toxic = c.label
            group by c.label
        )
    )
"""

# Orders with the indices of their priority and state: the most frequent first, then by name.
STATES = """
    select year(o_orderdate)::double as year, p.priority, p.j, s.k
    from orders
    join (select o_orderpriority as priority, count(*) as n,
                 row_number() over (order by count(*) desc, o_orderpriority) - 1 as j
          from orders group by o_orderpriority) p on p.priority = o_orderpriority
    join (select o_orderstatus as status,
                 row_number() over (order by count(*) desc, o_orderstatus) - 1 as k
          from orders group by o_orderstatus) s on s.status = o_orderstatus
"""

CELLS = f"""
    select priority, j, k, count(*)::double as n,
           count(*)::double / sum(count(*)) over (partition by j) as p,
           ln(count(*)) - avg(ln(count(*))) over (partition by j) as odds
    from ({STATES}) group by priority, j, k
"""

# The tree over years with at most five levels: of all stretches of years the best cut, then the
# stretches that the cuts from the whole on lead to. A node stays inner if the leaves below differ.
YEAR_TREE = f"""
    with recursive rows as materialized ({STATES}),
    years as (select year, row_number() over (order by year) as i from (select distinct year from rows)),
    counts as (select i, k, count(*)::double as n from rows join years using (year) group by i, k),
    stretches as (
        select a.i as lo, b.i as hi, k, coalesce(sum(n), 0) as n
        from years a join years b on a.i <= b.i cross join (select distinct k from rows)
        left join counts using (k)
        where counts.i is null or counts.i between a.i and b.i
        group by a.i, b.i, k
    ),
    nodes as (
        select lo, hi, sum(n) as n, 1 - sum(n * n) / (sum(n) * sum(n)) as impurity from (
            select lo, hi, k, n, sum(n) over (partition by lo, hi) as whole from stretches
        ) group by lo, hi
    ),
    votes as (
        select lo, hi, k as vote from stretches
        qualify row_number() over (partition by lo, hi order by n desc, k) = 1
    ),
    cuts as (
        select w.lo, w.hi, l.hi as cut,
               w.impurity - l.n / w.n * l.impurity - r.n / w.n * r.impurity as gain
        from nodes w join nodes l on l.lo = w.lo and l.hi < w.hi
        join nodes r on r.lo = l.hi + 1 and r.hi = w.hi
        qualify row_number() over (partition by w.lo, w.hi order by gain desc, cut) = 1
    ),
    grown as (
        select 1::bigint as lo, (select max(i) from years) as hi, 0 as depth,
               null::bigint as up_lo, null::bigint as up_hi, null::varchar as side
        union all
        select case when s = 'left' then c.lo else c.cut + 1 end,
               case when s = 'left' then c.cut else c.hi end, depth + 1, c.lo, c.hi, s
        from grown join cuts c using (lo, hi), (values ('left'), ('right')) sides(s)
        where gain > 0 and depth < 5
    ),
    leaves as (
        select g.lo, g.hi, vote from grown g join votes v on v.lo = g.lo and v.hi = g.hi
        where not exists (select 1 from grown c where c.up_lo = g.lo and c.up_hi = g.hi)
    ),
    inner_nodes as (
        select g.lo, g.hi from grown g join leaves l on l.lo >= g.lo and l.hi <= g.hi
        group by g.lo, g.hi having count(distinct vote) > 1
    ),
    kept as (
        select g.*, row_number() over (order by g.lo, g.hi desc) - 1 as node,
               exists (select 1 from inner_nodes i where i.lo = g.lo and i.hi = g.hi) as is_inner
        from grown g
        where up_lo is null or exists (
            select 1 from inner_nodes i where i.lo = g.up_lo and i.hi = g.up_hi)
    )
"""

YEAR_NODES = """
    select t.tree::int as tree, q.node::int as node, u.node::int as parent, q.side,
           case when q.is_inner then 0 end as feature,
           case when q.is_inner then (a.year + b.year) / 2 end as threshold,
           case when q.is_inner then round(c.gain, 9) + 0.0 end as gain,
           round(n.impurity, 9) + 0.0 as impurity, n.n::bigint as n, v.vote::double as prediction
    from kept q join nodes n using (lo, hi) join votes v using (lo, hi)
    left join kept u on u.lo = q.up_lo and u.hi = q.up_hi
    left join cuts c on c.lo = q.lo and c.hi = q.hi
    left join years a on a.i = c.cut left join years b on b.i = c.cut + 1
    cross join (select unnest(range({trees})) as tree) t
"""

YEAR_VOTES = f"""
    {YEAR_TREE}
    select year, vote::double as prediction, count(*) as n
    from rows join years using (year)
    join kept q on not q.is_inner and i between q.lo and q.hi
    join (
        select q.lo, q.hi, min(l.vote) as vote from kept q join leaves l
          on l.lo >= q.lo and l.hi <= q.hi
        where not q.is_inner group by q.lo, q.hi
    ) v on v.lo = q.lo and v.hi = q.hi
    group by year, vote
"""

ORACLES: dict[str, str] = {
    "class_scan": """
        select 'Classe=' || label as "Classe", count(*) as files,
               (count(*) * (54 + 3 * 64 + 1))::bigint as total_bytes
        from embeddings where label < 5 group by label
    """,
    "featurize_partitions": """
        select vec_id, round(list_max(embedding)::double, 6) + 0.0 as value from embeddings
    """,
    "leading_variance": f"""
        select k::int as k, round(ratio, 6) + 0.0 as ratio, round(cumulative, 6) + 0.0 as cumulative
        from ({CURVE}) where k <= 8
    """,
    "label_ranks": """
        select l_partkey::varchar as label, count(*) as n, (row_number() over (
            order by count(*) desc, l_partkey::varchar) - 1)::double as index
        from lineitem where l_partkey is not null group by l_partkey
    """,
    "label_rank_rows": """
        select o_orderkey, index from orders left join (
            select o_custkey, (row_number() over (
                order by count(*) desc, o_custkey::varchar) - 1)::double as index
            from orders where o_custkey is not null group by o_custkey
        ) using (o_custkey)
    """,
    "exact_split": """
        select vec_id, 'class-' || label as "Classe", (row_number() over (
                   partition by label order by substr(md5(vec_id::varchar), 1, 8), vec_id::varchar
               ) > floor(0.8 * count(*) over (partition by label) + 0.5))::int as part
        from embeddings
    """,
    "lr_cells": f"""
        select priority, (row_number() over (partition by j order by k) - 1)::int as state,
               round(p, 5) + 0.0 as probability,
               first(k) over (partition by j order by p desc, k)::double as prediction
        from ({CELLS})
    """,
    "lr_cell_coefficients": f"""
        select a.k::int as class_index, a.j::int as feature,
               round(a.odds - b.odds, 5) + 0.0 as coefficient
        from ({CELLS}) a join ({CELLS}) b on a.k = b.k
        where b.j = (select max(j) from ({CELLS})) and a.j < b.j
    """,
    "lr_cell_intercepts": f"""
        select k::int as class_index, round(odds, 5) + 0.0 as intercept
        from ({CELLS}) where j = (select max(j) from ({CELLS}))
    """,
    "lr_cell_loss": f"""
        with c as ({CELLS}), s as (select k, sum(n) as n from c group by k)
        select round((select -sum(n * ln(n / (select sum(n) from c))) / sum(n) from s), 7) + 0.0
                   as first,
               round((select -sum(n * ln(p)) / sum(n) from c), 7) + 0.0 as last
    """,
    "tree_cells": YEAR_VOTES,
    "forest_cells": YEAR_VOTES,
    "tree_nodes": YEAR_TREE + YEAR_NODES.format(trees=1),
    "forest_nodes": YEAR_TREE + YEAR_NODES.format(trees=3),
    "named_report": f"""
        with p as materialized ({PER_LABEL})
        select 'class' as line, case label when 0 then 'accuracy' when 1 then 'good'
                                           else label::varchar end as name,
               round(precision, 6) + 0.0 as precision, round(recall, 6) + 0.0 as recall,
               round(f1, 6) + 0.0 as f1, support
        from p
        union all
        select 'summary', unnest(['accuracy', 'macro avg', 'weighted avg']),
               round(unnest([sum(tp)::double / sum(support), avg(precision),
                             sum(precision * support) / sum(support)]), 6) + 0.0,
               round(unnest([sum(tp)::double / sum(support), avg(recall),
                             sum(recall * support) / sum(support)]), 6) + 0.0,
               round(unnest([sum(tp)::double / sum(support), avg(f1),
                             sum(f1 * support) / sum(support)]), 6) + 0.0,
               sum(support)::bigint
        from p
    """,
    "binary_scan": """
        select 'Classe=' || label as "Classe", count(*) as files,
               (count(*) * (54 + 3 * 64 + 1))::bigint as total_bytes
        from embeddings group by label
    """,
    "parquet_roundtrip": """
        select 'class-' || label as "Classe", count(*) as n,
               sum(len(embedding))::bigint as n_values,
               round(sum(list_sum(list_transform(embedding,
                   lambda x, i: x::double * i))), 6) + 0.0 as weighted_sum
        from embeddings group by label
    """,
    "label_from_path": "select page_id, string_split(url, '/')[-2] as label from pages",
    "label_counts": """
        select string_split(url, '/')[-2] as label, count(*) as n from pages group by 1
    """,
    "array_to_vector": f"select vec_id, dim::int as dim, v as value from ({VALUES})",
    "image_scan": """
        select 'Classe=' || label as "Classe", 8 as height, 8 as width, 3 as n_channels,
               16 as mode, count(*) as n
        from embeddings group by label
    """,
    "image_to_rgb": f"""
        select 'Classe=' || label as "Classe",
               (((7 - dim // 8) * 8 + dim % 8) * 3 + channel)::int as pos,
               sum(level)::bigint as total
        from ({COLORS}) group by label, dim, channel
    """,
    "image_featurize": CHANNEL_TOTALS,
    "files_featurize": CHANNEL_TOTALS,
    "image_patches": f"""
        select 'Classe=' || label as "Classe", filter::int as filter, count(*) as n,
               round(avg(top::float::double), 6) + 0.0 as mean
        from (
            select vec_id, label, filter, greatest(max(response), 0.0) as top
            from (
                select vec_id, label, filter, y // 4 as patch_y, x // 4 as patch_x,
                       sum((level::float / 127.5::float - 1::float)::double
                           * ((5 * (y % 4) + 3 * (x % 4) + 7 * channel + 11 * filter) % 13 - 6)
                           / 8.0) as response
                from (select *, 7 - dim // 8 as y, dim % 8 as x from ({COLORS})),
                     (select unnest(range(5)) as filter)
                group by vec_id, label, filter, patch_y, patch_x
            )
            group by vec_id, label, filter
        )
        group by label, filter
    """,
    "featurize_maxpool": """
        select vec_id, round(list_max(embedding)::double, 6) + 0.0 as value from embeddings
    """,
    "featurize_linear": f"""
        select vec_id, m.j::int as dim,
               round(sum(v * ((7 * dim + 3 * m.j) % 11 - 5) / 8.0)::float::double, 6) + 0.0
                   as value
        from ({VALUES}) x, (select unnest(generate_series(0, 7)) as j) m
        group by vec_id, m.j
    """,
    "standard_scale": f"""
        select vec_id, dim::int as dim, round(z, 6) + 0.0 as z from ({SCALED})
    """,
    "correlation": f"""
        select i::int as i, j::int as j, round(r, 6) + 0.0 as r from ({CORRELATION})
    """,
    "variance_curve": f"""
        select k::int as k, round(ratio, 9) + 0.0 as ratio, round(cumulative, 9) + 0.0 as cumulative
        from ({CURVE})
    """,
    "choose_k": f"""
        select min(k)::int as k, (min(k) - 1)::int as index,
               round(min(cumulative), 9) + 0.0 as cumulative
        from ({CURVE}) where cumulative >= 0.95
    """,
    "pca_project": f"""
        select vec_id, component::int as component, round(sum(z * weight), 4) + 0.0 as value
        from ({SCALED}) join (
            select component, unnest(range(64)) as dim, unnest(axis) as weight
            from ({AXES}) where component < 32
        ) using (dim)
        group by vec_id, component
    """,
    "variance_powers": f"""
        with r as materialized ({CORRELATION}),
        d as (select count(distinct i) as n from r)
        select 1 as power, round(sum(r) / any_value(n), 9) + 0.0 as total
        from r, d where i = j
        union all
        select 2, round(sum(r * r) / any_value(n * n), 9) + 0.0 from r, d
        union all
        select 3, round(sum(a.r * b.r * c.r) / any_value(n * n * n), 9) + 0.0
        from r a join r b on a.j = b.i join r c on b.j = c.i and c.j = a.i, d
    """,
    "pca_norms": f"""
        select vec_id, round(sum(z * z), 6) + 0.0 as norm2 from ({SCALED}) group by vec_id
    """,
    "string_index": """
        select source as label,
               (row_number() over (order by count(*) desc, source) - 1)::double as index
        from documents where source is not null group by source
    """,
    "index_rows": """
        select vec_id, 'class-' || label as "Classe", index as "Classe_index"
        from embeddings join (
            select label, (row_number() over (
                order by count(*) desc, 'class-' || label) - 1)::double as index
            from embeddings group by label
        ) using (label)
    """,
    "hash_split": """
        select vec_id,
               case when (('0x' || substr(md5(vec_id::varchar), 1, 8))::ubigint)
                         / 4294967296.0 >= 0.8
                    then 'valid' else 'train' end as part
        from embeddings
    """,
    "random_split": "select vec_id, count(*) as parts from embeddings group by vec_id",
    "accuracy": """
        select count(*) as n, round(avg((quality = toxic)::int), 6) + 0.0 as accuracy,
               round(1.0 - avg((quality = toxic)::int), 6) + 0.0 as test_error
        from labels where quality is not null and toxic is not null
    """,
    "per_label_metrics": f"""
        select label, support, predicted, tp, round(fpr, 6) + 0.0 as fpr,
               round(tpr, 6) + 0.0 as tpr, round(precision, 6) + 0.0 as precision,
               round(recall, 6) + 0.0 as recall, round(f1, 6) + 0.0 as f1
        from ({PER_LABEL})
    """,
    "weighted_metrics": f"""
        select round(sum(tp)::double / sum(support), 6) + 0.0 as accuracy,
               round(sum(fpr * support) / sum(support), 6) + 0.0 as weighted_fpr,
               round(sum(tpr * support) / sum(support), 6) + 0.0 as weighted_tpr,
               round(sum(f1 * support) / sum(support), 6) + 0.0 as weighted_f1,
               round(sum(precision * support) / sum(support), 6) + 0.0 as weighted_precision,
               round(sum(recall * support) / sum(support), 6) + 0.0 as weighted_recall
        from ({PER_LABEL})
    """,
    "confusion": f"""
        with c as (select quality as label from {PAIRS} union select toxic from {PAIRS}),
        cells as (
            select a.label, b.label as prediction, count(l.doc_id) as n
            from c a cross join c b
            left join {PAIRS} l on l.quality = a.label and l.toxic = b.label
            group by a.label, b.label
        )
        select label, prediction, n,
               round(case when sum(n) over (partition by label) = 0 then 0.0
                          else n::double / sum(n) over (partition by label) end, 6) + 0.0
                   as row_share
        from cells
    """,
    "confusion_wide": """
        select label, count(*) filter (where toxic = 0) as predicted_0,
               count(*) filter (where toxic = 1) as predicted_1
        from (values (0), (1), (2)) c(label) left join labels on quality = label group by label
    """,
    "classification_report": f"""
        with p as materialized ({PER_LABEL})
        select label::varchar as name, round(precision, 6) + 0.0 as precision,
               round(recall, 6) + 0.0 as recall, round(f1, 6) + 0.0 as f1, support
        from p
        union all
        select 'accuracy', round(sum(tp)::double / sum(support), 6) + 0.0,
               round(sum(tp)::double / sum(support), 6) + 0.0,
               round(sum(tp)::double / sum(support), 6) + 0.0, sum(support)::bigint
        from p
        union all
        select 'macro avg', round(avg(precision), 6) + 0.0, round(avg(recall), 6) + 0.0,
               round(avg(f1), 6) + 0.0, sum(support)::bigint
        from p
        union all
        select 'weighted avg', round(sum(precision * support) / sum(support), 6) + 0.0,
               round(sum(recall * support) / sum(support), 6) + 0.0,
               round(sum(f1 * support) / sum(support), 6) + 0.0, sum(support)::bigint
        from p
    """,
}

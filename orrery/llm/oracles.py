"""SQL counterparts of those operators' queries that SQL can express."""

from __future__ import annotations


def _centroids(k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, salt: str = "3") -> str:
    """Every round as two tables: the nearest centroid of each vector, and the floored means."""
    steps = [
        f"""kept as materialized (
  select vec_id, list_transform(embedding, lambda x: cast(floor({scale} * cast(x as double)) as bigint)) as v
  from embeddings
  where len(embedding) = {dim} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {dim}
)""",
        f"""c0 as materialized (
  select cast(row_number() over (order by sha256('{salt}:' || vec_id)) - 1 as integer) as no, v as c
  from kept order by sha256('{salt}:' || vec_id) limit {k}
)""",
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} as materialized (
  select vec_id, v, best.no as no, best.d as d from (
    select vec_id, any_value(v) as v, min(struct_pack(d := d, no := no)) as best from (
      select vec_id, v, no, cast(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as bigint) as d
      from kept, c{r}
    ) group by vec_id
  )
)""")
        if r < rounds:
            steps.append(f"""c{r + 1} as materialized (
  select c{r}.no, coalesce(moved.c, c{r}.c) as c from c{r} left join (
    select no, list(m order by j) as c from (
      select no, j, cast((s - (s % n + n) % n) // n as bigint) as m from (
        select no, j, sum(v[j]) as s, count(*) as n from a{r}, range(1, {dim + 1}) t(j) group by no, j
      )
    ) group by no
  ) moved using (no)
)""")
    return "with " + ",\n".join(steps) + f"""
select a.vec_id, a.no as cluster, a.d as distance,
       cast(sum(a.d) over (partition by a.no) as bigint) as cluster_inertia, cast(sum(a.d) over () as bigint) as inertia,
       sha256(array_to_string(c.c, ',')) as centroid_sha256
from a{rounds} a join c{rounds} c on a.no = c.no
"""


_DIVERGENCE = r"""
with d as materialized (
  select row_number() over () as id, coalesce(text, '') as body, coalesce(lang, '') as lang, coalesce(source, '') as source
  from documents
), found as materialized (
  select id, lang, source, translate(term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from (
    select id, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d
  )
), kept as materialized (
  select lang, term, count(*) as total from found group by all having count(distinct id) >= 3
), grp as materialized (select distinct lang, source from d
), counted as materialized (
  select lang, source, term, count(*) as n from found semi join kept using (lang, term) group by all
), sizes as (select lang, source, sum(n) as whole from counted group by all
), langs as (select lang, count(*) as v, sum(total) as whole from kept group by all
), shares as materialized (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
         1 + (cast(coalesce(c.n, 0) as hugeint) + 1) * 1000000000 // (coalesce(s.whole, 0) + l.v) as p,
         1 + (cast(k.total as hugeint) + 1) * 1000000000 // (l.whole + l.v) as q
  from grp g join kept k on g.lang = k.lang join langs l on g.lang = l.lang
  left join sizes s on s.lang = g.lang and s.source = g.source
  left join counted c on c.lang = g.lang and c.source = g.source and c.term = k.term
), pairs as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source
  group by all
), parts as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(p.value, 0) as value
  from grp a join grp b on a.lang = b.lang and a.source <> b.source
  left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
  union all
  select lang, source, 'term', term, (p - q) * (p - q) // q from shares where n > 0 and p > q
), ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) as rank from parts
)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from ranked where part = 'pair' or rank <= 200
"""

ORACLES: dict[str, str] = {"op11_centroids": _centroids(), "op13_divergence": _DIVERGENCE}

"""Expected results of the operators on vectors and on fill-in-the-middle, as DuckDB SQL."""

from __future__ import annotations

_ASSIGNED = """
assigned{i} as materialized (
  select row, v, min(struct_pack(distance := d, cluster := k)) as best
  from (
    select row, v, k, cast(list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) as bigint) as d
    from vectors, centroids{i}
  )
  group by row, v
)"""

_MOVED = """
centroids{after} as materialized (
  select k, coalesce(m.c, b.c) as c
  from centroids{i} b left join (
    select k, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as c
    from (
      select best.cluster as k, i, sum(v[i]) as s, count(*) as n
      from (select best, v, unnest(range(1, 65)) as i from assigned{i})
      group by 1, 2
    )
    group by k
  ) m using (k)
)"""

_ROUNDS = ",".join(_ASSIGNED.format(i=i) + "," + _MOVED.format(i=i, after=i + 1) for i in range(3))

CENTROID_CLUSTERING = f"""
with vectors as materialized (
  select row_number() over () as row, vec_id,
    list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
  from embeddings
  where len(embedding) = 64
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64
),
centroids0 as materialized (
  select cast(row_number() over (order by digest, v) - 1 as integer) as k, v as c
  from (select v, sha256('1:' || vec_id) as digest from vectors order by digest nulls last, v limit 16)
),{_ROUNDS},{_ASSIGNED.format(i=3)},
by_cluster as (
  select best.cluster as cluster, cast(sum(best.distance) as bigint) as inertia from assigned3 group by 1
)
select vec_id, best.cluster as cluster, best.distance as distance, b.inertia as cluster_inertia,
  cast((select sum(inertia) from by_cluster) as bigint) as inertia,
  sha256(array_to_string(c, ',')) as centroid_sha256
from assigned3
join vectors using (row)
join by_cluster b on b.cluster = best.cluster
join centroids3 on k = best.cluster"""


FILL_IN_MIDDLE = r"""
with units as (
  select doc_id, coalesce(text, '') as text, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as digest,
    case when coalesce(text, '') = '' then [] else regexp_extract_all(text, '[^\n]*\n|[^\n]+') end as unit
  from documents
),
drawn as (
  select doc_id, text, unit, len(unit) as n, list_transform([1, 9, 17, 25], lambda p: cast('0x' || substr(digest, p, 8) as bigint)) as h
  from units
),
cuts as (
  select *, least(h[1] % (n + 1), h[2] % (n + 1)) as a, greatest(h[1] % (n + 1), h[2] % (n + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h[3] % 100 >= 100 then 'plain'
      when h[4] % 100 < 50 then 'spm' else 'psm' end as form
  from drawn
),
parts as (
  select *, array_to_string(unit[1 : a], '') as prefix, array_to_string(unit[a + 1 : b], '') as middle,
    array_to_string(unit[b + 1 :], '') as suffix
  from cuts
)
select doc_id, cast(n as bigint) as n, form,
  case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
  case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
  sha256(case form when 'plain' then text
    when 'psm' then concat('<P>', prefix, '<S>', suffix, '<M>', middle)
    else concat('<S>', suffix, '<P>', prefix, '<M>', middle) end) as output_sha256,
  sha256(text) as restored_sha256
from parts"""


# All pairs, which DuckDB can only do for small tables.
EMBEDDING_NEAR_DEDUP = """
with recursive vectors as (
  select vec_id, cast(embedding as double[]) as v,
    coalesce(len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
      and len(list_filter(embedding, lambda x: x <> 0)) > 0, false) as usable
  from embeddings
),
links as (
  select a.vec_id as a, b.vec_id as b
  from vectors a, vectors b
  where a.vec_id <> b.vec_id and a.usable and b.usable and len(a.v) = len(b.v)
    and case when a.usable and b.usable and len(a.v) = len(b.v) then list_cosine_similarity(a.v, b.v) >= 0.9 end
),
reached as (
  select vec_id as a, vec_id as b from vectors
  union
  select r.a, l.b from reached r join links l on l.a = r.b
)
select vec_id, coalesce(n, 0) as n_links, first as component_id, vec_id = first as kept
from vectors
left join (select a, count(*) as n from links group by a) on a = vec_id
join (select a as id, min(b) as first from reached group by a) on id = vec_id"""

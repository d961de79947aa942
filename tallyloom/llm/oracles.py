"""SQL (DuckDB) for what the queries return, written from their contracts."""

from .license_scan import PHRASES, TEMPLATES, THRESHOLD

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
LOW_TEXT = LOWER.format("coalesce(text, '')")

OP1 = f"""
with parts as (
  select page_id, {LOWER.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
rules(rule_host, rule_path, v) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits as (
  select page_id, host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule, arg_max(v, length(rule_host || rule_path)) as v
  from (select distinct * from parts) join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  group by all),
judged as (
  select p.page_id, p.host, p.path, f.rule, f.v,
    f.rule is null and regexp_matches(p.host, '(^|\\.)(spam-farm\\.example\\.(org|net)|spam([0-9]|[1-9][0-9]{{1,2}}|[12][0-9]{{3}})\\.example\\.org)$') as by_list
  from parts p left join fits f on p.page_id is not distinct from f.page_id and p.host = f.host and p.path = f.path)
select page_id, host, path, rule, coalesce(v, case when by_list then 'block' else 'allow' end) as verdict, by_list from judged
"""

SYMBOLS = "!#$%&*|@^~<>{}[]\\"
OP3 = f"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size,
    case when length(coalesce(text, '')) = 0 then 0.25::double
         else 0.25::double + 0.75::double * (length(translate(text, '{SYMBOLS}', ''))::double / length(text)::double) end as w,
    (('0x' || substr(md5('7|' || coalesce(doc_id::varchar, '')), 1, 13))::bigint::double + 0.5::double) / 4503599627370496::double as u
  from documents),
s0 as (select source, sum(size)::bigint as source_size from d group by 1),
s1 as (select *, ((row_number() over (order by source nulls last) - 1) % 3 + 1)::bigint as weight, 3 * source_size as cap from s0),
s2 as (select *, row_number() over (order by cap::double / weight::double, source nulls last) as rank,
         (sum(source_size) over ())::double - coalesce(sum(cap) over (order by cap::double / weight::double, source nulls last rows between unbounded preceding and 1 preceding), 0)::double as free,
         (sum(weight) over ())::double - coalesce(sum(weight) over (order by cap::double / weight::double, source nulls last rows between unbounded preceding and 1 preceding), 0)::double as rest_weight from s1),
s3 as (select *, free / rest_weight as level, cap::double / weight::double <= free / rest_weight as is_full from s2),
s4 as (select *, min(case when not is_full then rank end) over () as first_open from s3),
s5 as (select source, source_size, case when first_open is null or rank < first_open then cap::double
         else max(case when rank = first_open then level end) over () * weight end as target from s4),
s6 as (select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as epochs from s5),
k as (select d.*, -ln(u) / w as key from d),
o as (select *, coalesce(sum(size) over (partition by source order by key, doc_id, size rows between unbounded preceding and 1 preceding), 0) as before from k)
select doc_id, size::bigint as size, source_size, target,
  (case when size = 0 then 0 else size * (epochs + case when before + size / 2.0 <= target - epochs * source_size then 1 else 0 end) end)::bigint as taken
from o join s6 on o.source is not distinct from s6.source
"""

OP7 = f"""
with recursive w as materialized (
  select doc_id, list_filter(regexp_split_to_array({LOW_TEXT}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws from documents),
sh as materialized (
  select doc_id, list_distinct(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) end) as s from w),
t as (select doc_id, len(s) as n, unnest(s) as t from sh),
f as (select t, count(*) as f from t group by 1),
r as (select doc_id, n, t.t, row_number() over (partition by doc_id order by f, t.t) as i from t join f on t.t = f.t),
p as (select * from r where i <= n - (3 * n + 3) // 4 + 1),
c as (select distinct a.doc_id as a, b.doc_id as b from p a join p b on a.t = b.t and a.doc_id < b.doc_id and 4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n)),
e as materialized (select a, b from (select a, b, len(list_intersect(x.s, y.s)) as o, len(x.s) as nx, len(y.s) as ny
   from c join sh x on x.doc_id = a join sh y on y.doc_id = b) where 100 * o >= 75 * (nx + ny - o)),
g as materialized (select a, b from e union select b, a from e),
reach(a, b) as (select a, b from g union select reach.a, g.b from reach join g on reach.b = g.a),
least_of as (select a, min(b) as m from reach group by 1)
select sh.doc_id, len(s)::bigint as n_shingles, least(sh.doc_id, coalesce(m, sh.doc_id)) as component_id from sh left join least_of on sh.doc_id = a
"""

NO_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_phrases = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in PHRASES.items())
_templates = ", ".join(f"('{t}', '{label}')" for t, label in TEMPLATES.items())
OP8 = f"""
with w as (select doc_id, row_number() over () as rid, coalesce(text, '') as text,
    list_filter(regexp_split_to_array({LOW_TEXT}, '{NO_WORD}'), lambda x: x <> '') as ws from documents),
phrases(phrase, label, k) as (values {_phrases}),
hits as (select rid, label, unnest(list_filter(range(0, len(ws) - k + 1), lambda i: array_to_string(ws[i+1:i+k], ' ') = phrase)) as pos from w, phrases where len(ws) >= k),
base as (select rid, count(*) as n, min(pos) as first, max(pos) as last, list_sort(list_distinct(list(label))) as labels from hits group by 1),
templates as (select label, len(string_split(t, ' ')) as l, list_distinct(string_split(t, ' ')) as ts from (values {_templates}) v(t, label)),
shares as (select rid, label, list_max(list_transform(range(0, len(ws), l), lambda i: len(list_intersect(ts, ws[i+1:i+2*l])))) as o, len(ts) as n from w, templates
  where len(list_intersect(ts, ws)) >= ceil({THRESHOLD} * len(ts) - 1e-9)),
found as (select rid, list(label) as labels, max(o::double / n::double) as share from shares where o >= ceil({THRESHOLD} * n - 1e-9) group by 1)
select doc_id, len(ws)::bigint as n_words, coalesce(n, 0)::bigint as n_base, first::bigint as first_word, last::bigint as last_word,
  coalesce(array_to_string(base.labels, ','), '') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ',') as labels,
  case when n > 0 then 1.0::double else coalesce(share, 0.0)::double end as score
from w left join base on base.rid = w.rid left join found on found.rid = w.rid
"""

OP9 = """
with l0 as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 as line_no from documents),
l as materialized (select doc_id, line_no, list_distinct(list_filter(regexp_split_to_array(lower(line), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) as s from l0),
long as (select *, len(s) as n from l where len(s) >= 1),
sets as materialized (select list_sort(s) as s, any_value(n) as n, min((doc_id, line_no)) as place from long group by 1),
t as (select place, n, unnest(s) as t from sets),
f as (select t, count(*) as f from t group by 1),
r as (select place, n, t.t, row_number() over (partition by place order by f, t.t) as i from t join f on t.t = f.t),
p as (select * from r where i <= n - (3 * n + 3) // 4 + 1),
c as (select distinct a.place as a, b.place as b from p a join p b on a.t = b.t and a.place < b.place and 4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n)),
later as (select distinct b from (select b, len(list_intersect(x.s, y.s)) as o, x.n as nx, y.n as ny from c join sets x on x.place = a join sets y on y.place = b)
  where 100 * o >= 75 * (nx + ny - o)),
gone as (select long.doc_id, long.line_no from long join sets on list_sort(long.s) = sets.s where (doc_id, line_no) <> place or place in (select b from later))
select doc_id, count(*)::bigint as n_lines, count(g_no)::bigint as n_removed, coalesce(string_agg(g_no::varchar, ',' order by g_no), '') as removed
from (select l.doc_id, l.line_no, gone.line_no as g_no from l left join gone on gone.doc_id = l.doc_id and gone.line_no = l.line_no) group by 1
"""

OP10 = f"""
with n as (select doc_id, {LOW_TEXT} as t from documents),
g as (select t, max(doc_id) as keep_id, count(*) as group_size from n group by 1)
select doc_id, keep_id, group_size::bigint as group_size, doc_id = keep_id as kept, sha256(n.t) as text_sha256 from n join g on n.t = g.t
"""

OP11 = """
with v as materialized (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as materialized (select a.vec_id as anchor_id, a.label as own, b.vec_id, b.label, list_inner_product(a.q, b.q)::bigint as score from v a join v b on a.vec_id % 50 = 0),
p as (select anchor_id, own, vec_id as positive_id, score as positive_score from s where own = label and vec_id <> anchor_id
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, positive_id, (row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id))::integer as rank, vec_id as negative_id, positive_score, score as negative_score
from p join s on s.anchor_id = p.anchor_id and s.label <> p.own and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify rank <= 3
"""

#: Five bits at a time, from the two hex digits that hold them.
BASE32 = "array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr({0}, (5 * i // 4 + 1)::integer, 2))::integer >> (3 - 5 * i % 4)::integer) & 31), 1)), '')"
OP12 = f"""
with p as (select page_id, coalesce(html, '') as h from pages),
g as (select h, min(page_id) as first_id from p group by 1)
select page_id, strlen(p.h)::bigint as payload_bytes, {BASE32.format("sha1(p.h)")} as payload_digest,
  case when first_id is null or page_id = first_id then 'response' else 'revisit' end as record_type, case when page_id = first_id then null else first_id end as refers_to
from p join g on p.h = g.h
"""


def merkle_sql(levels: int = 7) -> str:
    """Level by level: l is a level's nodes by tree and place, r the runs they form, a the leaves with their ancestors."""
    leaf = lambda text: "sha256(" + " || ".join(f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    bits = "list_reduce(list_prepend(n, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)"
    crc = "xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)), lambda c, b: xor(c >> 8, crcs[xor(c, b) & 255 + 1])), 4294967295)".replace("xor(c, b) & 255 + 1", "(xor(c, b) & 255) + 1")
    out = [
        f"with recursive t as (select list(v order by n) as crcs from (select n, {bits} as v from (select unnest(range(256))::bigint as n)))",
        f"d as (select doc_id, coalesce('s' || source, 'n') as tree, {leaf('text')} as leaf, case when {crc} % 5 = 0 then {leaf(LOWER.format('text'))} end as shown from documents, t)",
        "a0 as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos, leaf as node, coalesce(shown, leaf) as folded, '' as proof from d)",
        "l0 as (select tree, pos, leaf as digest from a0)",
    ]

    def climb(k: int, tree: str) -> list[str]:
        run = f"r{tree}{k} as (select tree, pos // 16 as run, string_agg(digest, '' order by pos) as all_of, sum(count(*)) over (partition by tree) as n from l{tree}{k} group by tree, pos // 16)"
        up = f"l{tree}{k + 1} as (select tree, run as pos, case when n > 1 then sha256(all_of) else all_of end as digest from r{tree}{k})"
        return [run, up]

    def follow(k: int, tree: str, at: str, key: str) -> str:
        return (
            f"{at}{k + 1} as (select a.* replace (case when n > 1 then pos // 16 else pos end as pos, proof || case when n > 1 then left(all_of, 64 * (pos % 16)::integer) || substr(all_of, 64 * (pos % 16)::integer + 65) else '' end as proof,"
            f" case when n > 1 then sha256(left(all_of, 64 * (pos % 16)::integer) || folded || substr(all_of, 64 * (pos % 16)::integer + 65)) else folded end as folded) from {at}{k} a join r{tree}{k} r on r.tree = {key} and r.run = a.pos // 16)"
        )

    for k in range(levels):
        out += [*climb(k, ""), follow(k, "", "a", "a.tree")]
    out += [f"s as (select tree as own, digest, row_number() over (order by tree) - 1 as pos from l{levels})", "lt0 as (select '' as tree, pos, digest from s)"]
    out.append(f"b0 as (select a.* replace (s.pos as pos), s.digest as subroot from a{levels} a join s on s.own = a.tree)")
    for k in range(levels):
        out += [*climb(k, "t"), follow(k, "t", "b", "''")]
    return ",\n".join(out) + f"\nselect doc_id, leaf, subroot, digest as root, sha256(proof) as proof_sha256, folded as folded_root, folded = digest as verified from b{levels}, lt{levels}"


ORACLES = {"op1_url_filter": OP1, "op3_mixing": OP3, "op7_ngram_join": OP7, "op8_license_scan": OP8, "op9_line_dedup": OP9, "op10_exact_dedup": OP10, "op11_hard_negatives": OP11, "op12_warc": OP12, "op13_merkle_manifest": merkle_sql()}

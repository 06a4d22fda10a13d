"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

from rxsieve.llm.line_dedup import BLANK, BLOCK, ENTITIES, HIDDEN, HOST, LEAST_PAGES, RATIO, TAG

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def near_copies() -> str:
    """Links by counting the shared shingles of every pair that shares one; components by a recursive walk."""
    return f"""
with recursive texts as (
  select doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') as words from documents
), shingles as (
  select doc_id, unnest([array_to_string(words[i:i + 4], ' ') for i in range(1, greatest(len(words) - 4, 1) + 1)]) as shingle
  from texts where len(words) > 0
), sets as (select distinct doc_id, shingle from shingles),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as both from sets a join sets b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all
), links as (
  select s.a, s.b from shared s join sizes x on x.doc_id = s.a join sizes y on y.doc_id = s.b
  where 100 * s.both >= 75 * (x.n + y.n - s.both)
), reached as (
  select doc_id, doc_id as other from documents
  union select r.doc_id, l.b from reached r join links l on l.a = r.other
), least as (select doc_id, min(other) as component_id from reached group by doc_id)
select d.doc_id, coalesce(s.n, 0) as n_shingles, l.component_id, d.doc_id = l.component_id as kept
from documents d join least l using (doc_id) left join sizes s using (doc_id)"""


def passages() -> str:
    words = "regexp_extract_all(translate(text, '{}', '{}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(UPPER, LOWER)
    return f"""
with texts as (select doc_id, coalesce({words}, []) as words from documents),
items as (select cast(item_id as varchar) as item_id, {words} as words from benchmark),
windows as (
  select distinct item_id, least(len(words), 10) as width, unnest([array_to_string(words[i:i + 9], ' ') for i in range(1, greatest(len(words) - 9, 1) + 1)]) as passage
  from items where len(words) > 0
), widths as (select distinct width from windows),
places as (
  select doc_id, width, unnest(range(1, len(words) - width + 2)) as place, words from texts, widths where len(words) >= width
), found as (
  select p.doc_id, p.place, p.width, w.item_id from places p
  join windows w on w.width = p.width and w.passage = array_to_string(p.words[p.place:p.place + p.width - 1], ' ')
), hit as (select doc_id, count(distinct word) as n_hit from (select doc_id, unnest(range(place, place + width)) as word from found) group by doc_id),
named as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as items from found group by doc_id)
select t.doc_id, len(t.words) as n_words, coalesce(h.n_hit, 0) as n_hit, coalesce(n.n_items, 0) as n_items,
  sha256(coalesce(n.items, '')) as items_sha256, h.n_hit is not null as contaminated
from texts t left join hit h using (doc_id) left join named n using (doc_id)"""


def site_lines() -> str:
    text = f"regexp_replace(coalesce(html, ''), {_text(HIDDEN)}, '', 'g')"
    text = f"regexp_replace(regexp_replace({text}, {_text(BLOCK)}, chr(10), 'g'), {_text(TAG)}, '', 'g')"
    for entity, char in ENTITIES.items():
        text = f"replace({text}, {_text(entity)}, {_text(char)})"
    blank = " || ".join(f"chr({ord(c)})" for c in BLANK)
    return f"""
with parsed as (
  select page_id, row_number() over () as page, coalesce(lower(regexp_extract(url, {_text(HOST)}, 1)), '') as host,
    list_filter(list_transform(string_split({text}, chr(10)), lambda x: trim(x, {blank})), lambda x: x <> '') as lines
  from pages
), totals as (select host, count(*) as host_pages from parsed group by host),
often as (
  select l.host, l.line from (select host, page, unnest(list_distinct(lines)) as line from parsed) l join totals t using (host)
  group by l.host, l.line, t.host_pages having count(*) >= {LEAST_PAGES} and count(*) > {RATIO} * t.host_pages
), dropped as (select host, list(line) as boilerplate from often group by host),
kept as (
  select p.*, list_filter(p.lines, lambda x: not list_contains(coalesce(d.boilerplate, []), x)) as rest
  from parsed p left join dropped d using (host)
)
select page_id, host, len(lines) as n_lines, len(lines) - len(rest) as n_dropped, array_to_string(rest, chr(10)) as text from kept"""


def prefix_trie() -> str:
    """Every prefix as a list of turns; sums over a subtree by handing each node's to all its prefixes. The checksum is made bit by bit."""
    crc = f"list_reduce([{2**32 - 1}::ubigint] || list_transform(string_split(conv_id::varchar, ''), lambda ch: ascii(ch)::ubigint), lambda crc, byte: list_reduce([xor(crc, byte)] || list_transform(range(8), lambda i: i::ubigint), lambda x, i: xor(x >> 1, 3988292384::ubigint * (x & 1))))"
    return f"""
with own as (
  select conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} order by turn nulls first) as turns
  from conversations where conv_id is not null group by conv_id
), heads as (select conv_id, turns, (xor({crc}, {2**32 - 1}) % 4)::bigint as h from own),
rebuilt as (
  select a.conv_id, list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) as path
  from heads a left join own b on b.conv_id = a.conv_id - a.conv_id % 20
), steps as (select conv_id, path, unnest(range(0, len(path) + 1)) as depth from rebuilt),
nodes as (
  select path[1:depth] as node, depth, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where depth = len(path)), '')) as ends_sha256
  from steps group by all
), below as (select node[1:depth - 1] as node, depth - 1 as depth, count(*) as n_children from nodes where depth > 0 group by all),
worth as (
  select n.*, coalesce(b.n_children, 0) as n_children,
    case when n.depth > 0 then (n.n_convs - 1) * len(regexp_extract_all(n.node[n.depth].text, '[^\\x20\\x09-\\x0D]+')) else 0 end as worth
  from nodes n left join below b on b.node = n.node and b.depth = n.depth
), handed as (select node, depth, n_children, worth, unnest(range(0, depth + 1)) as to_depth from worth),
sums as (select node[1:to_depth] as node, to_depth as depth, sum((n_children = 0)::bigint)::bigint as n_leaves, sum(worth)::bigint as saved_tokens from handed group by all)
select w.conv_id, w.depth, p.conv_id as parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens, w.ends_sha256
from worth w join sums s on s.node = w.node and s.depth = w.depth left join nodes p on w.depth > 0 and p.depth = w.depth - 1 and p.node = w.node[1:w.depth - 1]"""


def near_vectors() -> str:
    """All pairs; components by a recursive walk."""
    return """
with recursive good as (
  select vec_id, embedding::double[] as v from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from good a join good b on a.vec_id <> b.vec_id and len(a.v) = len(b.v) where list_cosine_similarity(a.v, b.v) >= 0.9
), reached as (
  select vec_id, vec_id as other from embeddings
  union select r.vec_id, l.b from reached r join links l on l.a = r.other
), least as (select vec_id, min(other) as component_id from reached group by vec_id),
counted as (select a as vec_id, count(*) as n_links from links group by a)
select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept
from embeddings join least using (vec_id) left join counted using (vec_id)"""


ORACLES = {
    "op12_cross_polytope": near_vectors(),
    "op11_prefix_trie": prefix_trie(),
    "op3_site_line_dedup": site_lines(),
    "op5_minhash_near_dup": near_copies(),
    "op8_fm_index_decontamination": passages(),
}

"""SQL of the ledger, repair and manifest queries, written from their contracts."""

from __future__ import annotations

#: CRC-32 of an ASCII text, bit by bit.
CRC32 = """
    xor(4294967295::bigint, list_reduce(
        list_concat([4294967295::bigint], list_transform(string_split({0}, ''), lambda c: ascii(c)::bigint)),
        lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))
"""

# kind, its place, pattern, the group that is measured, its least length
_KINDS = [
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
    ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
]

_HITS = " union all ".join(
    f"""
        select r, {i} as kind, '{name}' as name, {least} as least, unnest(range(1, len(m) + 1)) as k, unnest(m) as m, unnest(g) as g,
               unnest(gaps[:len(m)]) as gap
        from (select r, regexp_extract_all(t, '{pattern}', 0) as m, regexp_extract_all(t, '{pattern}', {group}) as g,
                     string_split_regex(t, '{pattern}') as gaps from d where regexp_matches(t, '{pattern}'))
    """
    for i, (name, pattern, group, least) in enumerate(_KINDS)
)

SECRETS = f"""
    with d as (
        select row_number() over () as r, doc_id, coalesce(text, '') as t from documents
    ), hits as ({_HITS}
    ), placed as (
        select *, sum(length(gap) + length(m)) over (partition by r, kind order by k) as stop from hits
    ), span as (
        select r, kind, name, stop - length(m) as start, name || ':' || (stop - length(m))::bigint || ':' || stop::bigint as s
        from placed where length(g) >= least
    ), per as (
        select r, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex,
               coalesce(string_agg(s, ',' order by start, kind) filter (kind < 3), '') as base, string_agg(s, ',' order by start, kind) as spans
        from span group by r
    )
    select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
           sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
    from d left join per using (r)
"""


def _field(value: str) -> str:
    text = f"({value})::varchar"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def _tree(name: str, leaves: str) -> str:
    """All levels of the trees of a table of leaves (g, i, n, h)."""
    return f"""{name} as (
        select g, 0 as lvl, i, n, h from {leaves}
        union all
        select g, lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' order by i)) from {name} where n > 1 group by g, lvl, i // 3, n
    )"""


def _walk(name: str, start: str, tree: str) -> str:
    """From (r, g, i, n, x, proof) up a tree: x is the digest so far, proof the siblings so far."""
    return f"""{name} as (
        select r, g, 0 as lvl, i, n, x, proof from {start}
        union all
        select w.r, w.g, w.lvl + 1, w.i // 3, (w.n + 2) // 3,
               sha256(string_agg(case when t.i = w.i then w.x else t.h end, '' order by t.i)),
               w.proof || coalesce(string_agg(t.h, '' order by t.i) filter (t.i <> w.i), '')
        from {name} w join {tree} t on t.g = w.g and t.lvl = w.lvl and t.i // 3 = w.i // 3
        where w.n > 1 group by w.r, w.g, w.lvl, w.i, w.n, w.x, w.proof
    )"""


MANIFEST = f"""
    with recursive row as (
        select *, coalesce('=' || source, '') as g, {_leaf("text")} as h,
               {_leaf(f"case when ({CRC32.format('doc_id::varchar')}) % 2 = 0 then replace(text, chr(10), '') else text end")} as x
        from documents
    ), leaves as (
        select *, row_number() over (order by g, doc_id nulls first, h) as r,
               row_number() over (partition by g order by doc_id nulls first, h) - 1 as i, count(*) over (partition by g) as n
        from row
    ), {_tree("tree", "leaves")}, subroots as (
        select '' as g, t.g as name, t.h, row_number() over (order by t.g) - 1 as i, count(*) over () as n from tree t where t.n = 1
    ), {_tree("top", "subroots")}, start as (
        select r, g, i, n, x, '' as proof from leaves
    ), {_walk("up", "start", "tree")}, middle as (
        select u.r, s.g, s.i, s.n, u.x, u.proof from up u join subroots s on s.name = u.g where u.n = 1
    ), {_walk("on_up", "middle", "top")}
    select l.doc_id, l.h as leaf, s.h as subroot, t.h as root, sha256(u.proof) as proof_sha256, u.x as folded_root, u.x = t.h as verified
    from leaves l join on_up u on u.r = l.r and u.n = 1 join subroots s on s.name = l.g join top t on t.n = 1
"""


def _least(*ways: str) -> str:
    """The cheapest of ways (cost, audit), the ASCII-least of equal costs."""
    return f"list_sort([{', '.join(ways)}])[1]"


def _plus(cost: str, letter: str, way: str) -> str:
    return f"{{'c': {way}.c + {cost}, 'a': '{letter}' || {way}.a}}"


def _closed(way: str) -> str:
    """Four ways, one per state, with inserts before them: after a missing u comes a missing a, and so on."""
    chains = {0: (0, 2, 3), 1: (1, 2, 3), 2: (2, 3), 3: (3, 2)}
    after = [_least(*[_plus(str(3 * k), "I" * k, f"{way}{s}") for k, s in enumerate(chain)]) for chain in chains.values()]
    return ", ".join(f"{w} as s{i}" for i, w in enumerate(after))


def _row_ways(state: int) -> str:
    """Ways over one row in a state: deleted, kept or given the role that the state waits for."""
    wanted, after = (("u", 2), ("u", 2), ("a", 3), ("u", 2))[state]
    extra = "(case when fault = 3 then 3 else 0 end)"
    never = "{'c': 1000000000::bigint, 'a': ''}"
    keep = f"when ini = '{wanted}' then {_plus(extra, 'K', f's{after}')}"
    if state == 0:
        keep += f" when ini = 's' then {_plus(extra, 'K', 's1')}"
    rerole = f"case when fault in (1, 2) then {never} else {_plus(f'3 + {extra}', 'R', f's{after}')} end"
    return f"{_least(_plus('4', 'D', f's{state}'), f'case when fault in (1, 2) then {never} {keep} else {never} end', rerole)} as d{state}"


REPAIR = rf"""
    with recursive marked as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
               ({CRC32.format("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")}) % 20 as kind
        from conversations
    ), rows_after as (
        select conv_id, turn, case when kind = 4 then 'user' else role end as role, unnest(case when kind = 3 then [0, 1] else [0] end) as copy,
               case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
        from marked where kind <> 0
    ), said as (
        select *, sha256(length(role) || ':' || role || text) as d, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body
        from rows_after
    ), ranked as (
        select *, row_number() over (partition by conv_id order by turn nulls first, d, copy) as k,
               case when body = '' then 1 when row_number() over (partition by conv_id, role, text order by turn nulls first, d, copy) > 1 then 2
                    when right(body, 1) not in ('.', '!', '?') then 3 else 0 end as fault, left(role, 1) as ini,
               count(*) over (partition by conv_id) as n
        from said
    ), pairs as (
        select *, lag(ini) over (partition by conv_id order by k) || ini as pair from ranked
    ), counted as (
        select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
               count(*) filter (fault = 1) as blank, count(*) filter (fault = 2) as duplicate, count(*) filter (fault = 3) as truncated,
               count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
        from pairs group by conv_id
    ), ends as (
        select {{'c': 0::bigint, 'a': ''}} as d0, {{'c': 1000000000::bigint, 'a': ''}} as d1, {{'c': 1000000000::bigint, 'a': ''}} as d2,
               {{'c': 0::bigint, 'a': ''}} as d3
    ), best as (
        select conv_id, n as k, {_closed("d")} from counted, ends
        union all
        select conv_id, k, {_closed("d")} from (
            select b.conv_id, b.k - 1 as k, {", ".join(map(_row_ways, range(4)))}
            from best b join ranked r on r.conv_id is not distinct from b.conv_id and r.k = b.k
        )
    ), solved as (
        select conv_id, s0.c as cost, s0.a as audit from best where k = 0
    ), edits as (
        select conv_id, unnest(range(1, length(audit) + 1)) as e, unnest(string_split(audit, '')) as edit from solved where audit <> ''
    ), aligned as (
        select *, count(*) filter (edit <> 'I') over (partition by conv_id order by e) as k,
               count(*) filter (edit <> 'D') over (partition by conv_id order by e) as o from edits
    ), lines as (
        select a.conv_id, a.e, a.o, a.edit, r.role, case when a.edit = 'I' then '' else r.text end as text,
               max(case when a.o = 1 and a.edit = 'K' and r.ini = 's' then 1 else 0 end) over (partition by a.conv_id) as s
        from aligned a left join ranked r on r.conv_id is not distinct from a.conv_id and r.k = a.k
        where a.edit <> 'D'
    ), texts as (
        select conv_id, string_agg(case when edit = 'K' then role when (o - s) % 2 = 1 then 'user' else 'assistant' end || ':' || text, chr(10) order by e) as t
        from lines group by conv_id
    ), original as (
        select distinct conv_id from conversations
    )
    select o.conv_id, coalesce(c.gaps, 0) as gaps, coalesce(c.blank, 0) as blank, coalesce(c.duplicate, 0) as duplicate,
           coalesce(c.truncated, 0) as truncated, coalesce(c.illegal, 0) as illegal, coalesce(s.cost, 0) as cost, coalesce(s.audit, '') as audit,
           sha256(coalesce(t.t, '')) as repaired_sha256
    from original o left join counted c on c.conv_id is not distinct from o.conv_id
                    left join solved s on s.conv_id is not distinct from o.conv_id
                    left join texts t on t.conv_id is not distinct from o.conv_id
"""

"""DuckDB equivalents of the registered queries, where SQL can express them."""

ORACLES = {
    "op1_warc": """
        with p as (
          select page_id, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as h from pages),
        d as (
          select *, min(page_id) over (partition by h) as first_id,
                 array_to_string(list_transform(range(32), lambda i: substr(
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + (((((instr('0123456789abcdef', substr(h, 1 + (5 * i) // 4, 1)) - 1) * 16
                     + instr('0123456789abcdef', substr(h, 2 + (5 * i) // 4, 1)) - 1)
                     >> (3 - (5 * i) % 4)) & 31))::bigint, 1)), '') as b32
          from p)
        select page_id, n as payload_bytes, b32 as payload_digest,
               case when page_id = first_id then 'response' else 'revisit' end as record_type,
               case when page_id = first_id then null else first_id end as refers_to
        from d
    """,
    "op5_chat": r"""
        with t as (
          select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
          from conversations
          union all select -7, 0, 'user', '\### Assistant: </turn> ok'
          union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        f as (
          select *, role || chr(10) || text || chr(10) as said,
                 case when role = 'assistant' then text else '' end as learned,
                 length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g'))
                 + length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g'))
                 + length('### : </turn>') + 1 as n
          from t)
        select conv_id, count(*) as n_turns,
               sha256(string_agg(said, '' order by turn, role, text)) as turns_sha256,
               sum(length(learned))::bigint as loss_chars,
               sha256(string_agg(learned, '' order by turn, role, text)) as loss_sha256,
               sum(n)::bigint as formatted_chars
        from f group by conv_id
    """,
    "op6_exact_dedup": """
        with t as (
          select doc_id,
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') as norm
          from documents)
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id = max(doc_id) over same as kept, sha256(norm) as text_sha256
        from t window same as (partition by norm)
    """,
    "op13_ranked_search": r"""
        with d as (
          select row_number() over () as r, doc_id, regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[0-9a-z\x{80}-\x{10FFFF}]+') as terms
          from documents),
        x as (select r, doc_id, unnest(terms) as term from d),
        f as (select r, doc_id, term, count(*) as tf from x group by all),
        l as (select r, count(*) as n_terms from x group by r),
        c as (select count(*) as n_docs, sum(n_terms)::bigint as n_all from l),
        q as (
          select distinct item_id, unnest(regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[0-9a-z\x{80}-\x{10FFFF}]+')) as term
          from benchmark),
        w as (
          select term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::bigint as weight
          from f, c where term in (select term from q) group by term, n_docs),
        s as (
          select item_id, r, doc_id, sum(weight * ((1000000000 * tf)
                   // (1000 * tf + 8 * (100 - 90 + (90 * n_terms * n_docs) // n_all))))::bigint as score
          from q join f using (term) join w using (term) join l using (r), c
          group by item_id, r, doc_id),
        o as (
          select *, row_number() over (partition by item_id order by score desc, doc_id) as rank
          from s where score > 0)
        select item_id, rank::int as rank, doc_id, score from o where rank <= 10
    """,
}

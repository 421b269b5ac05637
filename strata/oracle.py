"""DuckDB SQL forms of the library's column rules, for the value-equality
checks of every registered query (``__spark_entry__.oracle_sql``).

The rules are written anew here, so that an error in a pattern of the library
shows; only the tables of fixed values (names of characters, Windows-1252) are
shared with ``strata.functions.text``.
"""

from __future__ import annotations

from strata.functions import text as T


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


# Python's white space, as characters (``str.isspace``), and any run between two of them.
SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(x: str) -> str:
    return f"trim({x}, {q(SPACES)})"


def title(x: str) -> str:
    # every letter whose left neighbour has no case begins a word
    cased = "(upper({0}) <> lower({0}) or regexp_matches({0}, '[\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]'))"
    here, left = "substr(t, k, 1)", "substr(t, k - 1, 1)"
    start = f"(k = 1 or not {cased.format(left)})"
    chars = f"list_transform(range(1, length(t) + 1), lambda k: CASE WHEN {start} THEN upper({here}) ELSE {here} END)"
    return f"list_transform([lower({x})], lambda t: array_to_string({chars}, ''))[1]"


def words(x: str) -> str:
    blanks = " " * len(SPACES)
    return f"coalesce(list_filter(string_split(translate({x}, {q(SPACES)}, {q(blanks)}), ' '), lambda w: w <> ''), [])"


def word_count(x: str) -> str:
    return f"len({words(x)})::BIGINT"


def _entity_map() -> str:
    items = ", ".join(f"{q(k)}: {q(chr(v))}" for k, v in sorted(T.ENTITY_CODEPOINTS.items()))
    return "MAP {" + items + "}"


def _codepoint(n: str) -> str:
    western = ", ".join(f"{k}: {q(v)}" for k, v in T.CP1252_CHARS.items())
    return (f"CASE WHEN {n} BETWEEN 128 AND 159 THEN coalesce(map_extract_value(MAP {{{western}}}, {n}), chr({n})) "
            f"WHEN {n} > 0 AND {n} <= 1114111 AND NOT ({n} BETWEEN 55296 AND 57343) "
            f"THEN chr({n}) ELSE chr(65533) END")


def unescape(x: str) -> str:
    # the run of characters a reference may consist of, judged as a whole
    name = "regexp_extract(p, '^[A-Za-z0-9.-]*')"
    number = "regexp_extract(p, '^#([0-9A-Fa-f]+)', 1)"
    hexa = "ltrim(regexp_extract(p, '^#[xX]([0-9A-Fa-f]+)', 1), '0')"
    dec = f"ltrim({number}, '0')"
    named = f"map_extract_value({_entity_map()}, {name})"

    dec_n, hexa_n = f"coalesce(try_cast({dec} AS INTEGER), 0)", f"coalesce(try_cast('0x' || {hexa} AS INTEGER), 0)"

    def after(pattern: str) -> str:
        return f"regexp_replace(p, '^{pattern};?', '')"
    piece = (f"CASE WHEN i = 1 THEN p "
             f"WHEN {named} IS NOT NULL THEN {named} || {after('[A-Za-z0-9]+')} "
             f"WHEN {number} <> '' AND regexp_full_match({dec}, '[0-9]{{0,7}}') "
             f"THEN {_codepoint(dec_n)} || {after('#[0-9]+')} "
             f"WHEN regexp_matches(p, '^#[xX][0-9A-Fa-f]') AND length({hexa}) <= 6 "
             f"THEN {_codepoint(hexa_n)} || {after('#[xX][0-9A-Fa-f]+')} "
             f"ELSE '&' || p END")
    return (f"CASE WHEN strpos({x}, '&') = 0 THEN {x} ELSE "
            f"array_to_string(list_transform(string_split({x}, '&'), lambda p, i: {piece}), '') END")


# Whatever is no text: comments, script and style elements, tags, declarations.
# The given tables hold no CDATA section and no element that never ends.
MARKUP = (r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
          r"|</?[a-z](?:\x22[^\x22]*\x22|'[^']*'|[^'\x22>])*>|<[!?][^>]*>")


def html_to_text(x: str) -> str:
    parts = f"string_split(regexp_replace(coalesce({x}, ''), {q(MARKUP)}, chr(1), 'g'), chr(1))"
    return (f"array_to_string(list_filter(list_transform({parts}, lambda t: {strip(unescape('t'))}), "
            f"lambda s: s <> ''), ' ')")


def round2(x: str) -> str:
    """``rint(x * 100) / 100``."""
    return f"(round_even(({x}) * 100, 0) / 100)"


# ---------------------------------------------------------------- raw views

RAW_ORDERS = """
select 'ORD-' || l_orderkey || '-' || l_linenumber as order_id, 'C-' || o_custkey as customer_id,
       p_name as product_name,
       case when l_partkey % 3 = 0 then ' ' || lower(p_type) || ' ' else p_type end as category,
       case when l_suppkey % 97 = 0 then 'n/a' else cast(cast(l_quantity as int) as varchar) end as quantity,
       cast(cast(l_extendedprice as decimal(18,2)) as varchar) as unit_price,
       o_orderdate as order_date,
       'city-' || (o_custkey % 50) as shipping_city,
       case when l_partkey % 5 = 0 then ' ' || lower(n_name) || ' ' else n_name end as shipping_country,
       o_orderpriority as payment_method,
       case o_orderstatus when 'P' then ' Cancelled ' when 'F' then 'completed' else 'shipped' end as status,
       l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
     join nation on c_nationkey = n_nationkey join part on l_partkey = p_partkey
"""

SILVER_ORDERS = f"""
select order_id, customer_id, product_name, {title(strip('category'))} as category,
       coalesce(trunc(try_cast(quantity as double))::bigint, 0) as quantity,
       coalesce(try_cast(unit_price as double), 0.0) as unit_price,
       cast(order_date as timestamp) as order_date, shipping_city,
       {strip('upper(shipping_country)')} as shipping_country, payment_method,
       {strip('lower(status)')} as status,
       {round2('coalesce(trunc(try_cast(quantity as double))::bigint, 0) * coalesce(try_cast(unit_price as double), 0.0)')}
         as total_amount
from raw_orders
qualify row_number() over (partition by order_id order by l_shipdate desc, l_partkey desc, l_suppkey desc,
        l_quantity desc, l_extendedprice desc, l_discount desc, l_tax desc, l_returnflag desc,
        l_linestatus desc) = 1
"""


def with_views(body: str, **views: str) -> str:
    """``WITH name AS (...), ... body``."""
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in views.items())
    return f"WITH {ctes}\n{body}"


def orders_sql(body: str) -> str:
    silver = f"select * from ({SILVER_ORDERS}) where status is distinct from 'cancelled'"
    return with_views(body, raw_orders=RAW_ORDERS, silver_orders=silver)


def _day(e: str) -> str:
    return f"(timestamp '2024-01-01 00:00:00' + to_days(cast({e} as int)))"


RAW_PAGES = f"""
select cast(page_id as varchar) as page_id, ' ' || split_part(url, '/', 3) as space_key,
       regexp_extract(html, '<title>(.*?)</title>', 1) as title, 'current' as status, html as body_html,
       1 as version_number, 'u' || (page_id % 25) as created_by, {_day('page_id % 60')} as created_date,
       'u' || (page_id % 25) as last_updated_by, {_day('page_id % 60')} as last_updated_date
from pages
union all
select cast(page_id as varchar), ' ' || split_part(url, '/', 3), regexp_extract(html, '<title>(.*?)</title>', 1),
       'current', '<h2>Revised</h2>' || html, cast(page_id % 3 as int), 'u' || (page_id % 25),
       {_day('page_id % 60')}, 'u' || ((page_id + 1) % 25), {_day('page_id % 60 + 1')}
from pages
"""

RAW_COMMENTS = f"""
select cast(conv_id * 1000 + turn as varchar) as comment_id, cast(conv_id as varchar) as page_id,
       '<p>' || text || '</p>' as body_html, ' u' || ((conv_id * 7 + turn) % 40) as author,
       {_day('(conv_id + turn) % 60')} as created_date
from conversations
"""

SILVER_PAGES = f"""
select *, {word_count('body_text')} as word_count, coalesce(length(body_text), 0)::bigint as content_length
from (select page_id, {strip('upper(space_key)')} as space_key, {strip('title')} as title,
             {strip('lower(status)')} as status, body_html, version_number::bigint as version_number,
             created_by, created_date, last_updated_by, last_updated_date,
             {html_to_text('body_html')} as body_text
      from raw_pages
      qualify row_number() over (partition by page_id order by version_number desc,
                                 last_updated_date desc) = 1) p
"""

SILVER_COMMENTS = f"""
select *, {word_count('comment_text')} as word_count
from (select comment_id, page_id, body_html, {strip('author')} as author, created_date,
             {html_to_text('body_html')} as comment_text
      from raw_comments
      qualify row_number() over (partition by comment_id order by created_date desc) = 1) c
"""

SILVER_SPACES = f"""
select host as space_id, {strip("upper(' ' || host || ' ')")} as space_key,
       {strip('chr(9) || host')} as space_name, {strip("lower(' Global')")} as space_type,
       {html_to_text("'<p>Pages of <b>' || host || '</b> &amp; more</p>'")} as description
from (select distinct split_part(url, '/', 3) as host from pages) h
"""


def content_sql(body: str) -> str:
    return with_views(body, raw_pages=RAW_PAGES, raw_comments=RAW_COMMENTS,
                      silver_pages=SILVER_PAGES, silver_comments=SILVER_COMMENTS)


# ---------------------------------------------------------------- retrieval

def _tokens(x: str) -> str:
    return rf"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}]+')"


def _rank_round(x: str) -> str:
    return f"(round_even(({x}) * 1e9, 0) / 1e9)"


def _round6(x: str) -> str:
    return f"(round_even(({x}) * 1e6, 0) / 1e6)"


def bm25_scores_sql(docs: str, queries: str, prefix: str = "") -> str:
    """CTEs ``{prefix}s(query_id, doc_id, s)`` with raw BM25 scores."""
    p = prefix
    return f"""
    {p}d as (select doc_id, {_tokens('text')} as t from ({docs}) x),
    {p}stats as (select count(*)::double as n, avg(len(t)) as avgdl from {p}d),
    {p}q as (select distinct query_id, unnest(list_distinct({_tokens('query')})) as term from ({queries}) y),
    {p}occ as (select doc_id, len(t) as dl, unnest(t) as term from {p}d),
    {p}tf as (select doc_id, term, count(*) as tf, first(dl) as dl from {p}occ
              where term in (select term from {p}q) group by doc_id, term),
    {p}dft as (select term, count(*) as df from {p}tf group by term),
    {p}qidf as (select query_id, term, ln(1.0::double + (n - df + 0.5::double) / (df + 0.5::double)) as idf
                from {p}q join {p}dft using (term), {p}stats),
    {p}s as (select query_id, doc_id,
                    sum(idf * tf * 2.2::double / (tf + 1.2::double * (0.25::double + 0.75::double * dl / avgdl))) as s
             from {p}tf join {p}qidf using (term), {p}stats group by query_id, doc_id)"""


def bm25_sql(docs: str, queries: str, k: int) -> str:
    return f"""with {bm25_scores_sql(docs, queries)}
    select query_id, doc_id, rank::int as rank, {_round6('s')} as score from (
      select *, row_number() over (partition by query_id order by {_rank_round('s')} desc, doc_id) as rank
      from s) r where rank <= {k}"""


def vector_sql(k: int) -> str:
    return f"""
    with e as (select vec_id, label, embedding::double[] as v from embeddings),
    pe as (select label, unnest(range(1, len(v) + 1)) as pos, unnest(v) as x from e),
    c as (select label as query_id, list(m order by pos) as cv
          from (select label, pos, avg(x) as m from pe group by label, pos) a group by label),
    s as (select c.query_id, e.vec_id,
                 list_reduce(list_transform(list_zip(e.v, c.cv), lambda z: z[1] * z[2]), lambda a, b: a + b, 0.0::double)
                 / (sqrt(list_reduce(list_transform(e.v, lambda x: x * x), lambda a, b: a + b, 0.0::double))
                    * sqrt(list_reduce(list_transform(c.cv, lambda x: x * x), lambda a, b: a + b, 0.0::double))) as s
          from e, c)
    select query_id, vec_id, rank::int as rank, {_round6('s')} as score from (
      select *, row_number() over (partition by query_id order by {_rank_round('s')} desc, vec_id) as rank
      from s) r where rank <= {k}"""


def rrf_sql(k: int) -> str:
    chunks = f"""
        select doc_id::varchar || ':' || ((start_word // 150))::varchar as doc_id, doc_id as parent,
               array_to_string(w[start_word + 1 : start_word + 200], ' ') as text
        from (select doc_id, w, n, unnest(range(0, ((case when n <= 200 then 1
                      else ceil((n - 200) / 150)::int + 1 end) - 1) * 150 + 1, 150)) as start_word
              from (select doc_id, w, len(w) as n from (select doc_id, {words('text')} as w from documents) a
                    where len(w) > 0) b) c"""
    queries = "select item_id as query_id, text as query from benchmark"
    return f"""with {bm25_scores_sql('select doc_id, text from documents', queries, 'a_')},
    {bm25_scores_sql(f'select doc_id, text from ({chunks}) ch', queries, 'b_')},
    ch as ({chunks}),
    ra as (select query_id, doc_id, row_number() over (partition by query_id order by {_rank_round('s')} desc, doc_id) as rank
           from a_s),
    rb0 as (select query_id, doc_id as chunk_id, row_number() over (partition by query_id
                  order by {_rank_round('s')} desc, doc_id) as rank from b_s),
    rb1 as (select query_id, ch.parent as doc_id, min(rank) as best from rb0 join ch on rb0.chunk_id = ch.doc_id
            group by query_id, ch.parent),
    rb as (select query_id, doc_id, row_number() over (partition by query_id order by best, doc_id) as rank from rb1),
    u as (select query_id, doc_id, 1.0::double / (60.0::double + rank) as c from ra
          union all select query_id, doc_id, 1.0::double / (60.0::double + rank) from rb),
    f as (select query_id, doc_id, sum(c) as s, count(*) as n_lists from u group by query_id, doc_id)
    select query_id, doc_id, rank::int as rank, (round_even(s * 1e9, 0) / 1e9) as score, n_lists::bigint as n_lists from (
      select *, row_number() over (partition by query_id order by {_rank_round('s')} desc, doc_id) as rank from f) r
    where rank <= {k}"""

"""The same results in plain SQL, in their direct form, for a second engine.

These statements follow the definitions (user-by-user similarities, cross
products, windows over everything), not the plans of the operators, and are
meant for small tables.
"""

from __future__ import annotations

from ratingloom.functions.numeric import ITEM_STEP, MODULUS, MULTIPLIER, USER_STEP
from ratingloom.functions.text import NO_OVERVIEW, PUNCTUATION, STOPWORDS, TOKEN, WORD

PUNCT = PUNCTUATION.replace("'", "''")


def r6(x: str) -> str:
    return f"(floor(({x})*1e6+0.5)/1e6)"


def h(user: str, item: str, seed: str) -> str:
    m = MODULUS
    mixed = (
        f"((((({user})::BIGINT % {m}) * {USER_STEP}) % {m} + ((({item})::BIGINT % {m}) * {ITEM_STEP}) % {m}"
        f" + ((({seed})::BIGINT + 1) % {m} * {MULTIPLIER}) % {m}) % {m})"
    )
    return f"((((({mixed} * {mixed} + 1) % {m}) * {MULTIPLIER}) % {m} + {mixed}) % {m})"


EV = """ev AS (SELECT user_id, CAST(json_extract_string(props,'$.k') AS BIGINT) AS item_id,
  CAST(least(5.0, greatest(0.5, ceil(value/12.5)*0.5)) AS DOUBLE) AS rating, ts, event_id FROM events)"""
RT = EV + """, rt AS (SELECT user_id, item_id, arg_max(rating,(ts,event_id)) AS rating, max(ts) AS ts,
  arg_max(event_id,(ts,event_id)) AS event_id FROM ev GROUP BY 1,2)"""
PU = """pu AS (SELECT o_custkey AS user_id, l_partkey AS item_id, max(CAST(ceil(l_quantity/5.0)*0.5 AS DOUBLE)) AS rating
  FROM orders JOIN lineitem ON o_orderkey=l_orderkey GROUP BY 1,2)"""
IT = """it AS (SELECT coalesce(doc_id, p_partkey) AS item_id, p_name AS title, CAST(p_size AS DOUBLE) AS popularity, p_retailprice AS price,
  p_brand AS brand, p_type AS type, text, lang, source FROM documents FULL JOIN part ON doc_id=p_partkey)"""
CL = """cl AS (SELECT vec_id AS item_id, CAST(label AS BIGINT) AS cluster, CAST(p_size AS DOUBLE) AS popularity
  FROM embeddings JOIN part ON vec_id=p_partkey)"""
META = f"""full_meta AS (SELECT CASE WHEN p_brand='Brand#13' THEN concat('1997-08-', lpad(CAST(p_size AS VARCHAR),2,'0'))
    ELSE CAST(p_partkey AS VARCHAR) END AS id, p_partkey AS ord, p_size, p_name AS title, CAST(p_size AS DOUBLE) AS popularity,
    CASE WHEN quality=0 THEN '{NO_OVERVIEW}' ELSE text END AS overview,
    concat('The ', p_name, ' of the ', p_type, ' kind by ', p_brand) AS tagline,
    concat('[{{''id'': ', CASE WHEN p_size<10 THEN 'None' ELSE CAST(p_size AS VARCHAR) END, ', ''name'': ''', p_type,
      '''}}, {{''id'': 0, ''name'': ''', p_brand, '''}}]') AS genres
    FROM part LEFT JOIN documents ON p_partkey=documents.doc_id LEFT JOIN labels ON labels.doc_id=documents.doc_id),
  meta_raw AS (SELECT id, ord, title, popularity, overview, tagline, genres FROM full_meta UNION ALL
    SELECT id, ord-1000000000, title, popularity, NULL, tagline, genres FROM full_meta WHERE p_size>45),
  kw_raw AS (SELECT CAST(vec_id AS VARCHAR) AS id, concat('[{{''id'': ', label, ', ''name'': ''Group ', label,
    ', a group''}}, {{''id'': 7, ''name'': "Vector''s Group"}}]') AS keywords FROM embeddings),
  cr_raw AS (SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN n_chars<100 THEN '[]' ELSE
    concat('[{{''cast_id'': 1, ''name'': "O''', source, ' Senior"}}, {{''cast_id'': None, ''name'': ''Lang ', lang, '''}}]') END AS cast_list
    FROM documents),
  kw_rep AS (SELECT CAST(id AS BIGINT) AS id, CAST(id AS BIGINT)*2+1 AS ord, keywords FROM kw_raw UNION ALL
    SELECT vec_id, vec_id*2, CASE WHEN vec_id%2=0 THEN '[{{''id'': 1, ''name'': ''Early''}}]' END FROM embeddings WHERE vec_id%5=0),
  cr_rep AS (SELECT CAST(id AS BIGINT) AS id, CAST(id AS BIGINT)*2+1 AS ord, cast_list FROM cr_raw UNION ALL
    SELECT doc_id, doc_id*2, CASE WHEN doc_id%2=0 THEN '[]' END FROM documents WHERE doc_id%7=0),
  meta AS (SELECT CAST(id AS BIGINT) AS id, ord, title, popularity, overview, tagline, genres FROM meta_raw WHERE regexp_full_match(id,'[0-9]+')),
  kw AS (SELECT CAST(id AS BIGINT) AS id, keywords FROM kw_raw),
  cr AS (SELECT CAST(id AS BIGINT) AS id, cast_list FROM cr_raw)"""
FIRST = """mf AS (SELECT id, arg_min(title,ord) FILTER (WHERE title IS NOT NULL) AS title,
  arg_min(popularity,ord) FILTER (WHERE popularity IS NOT NULL) AS popularity,
  arg_min(overview,ord) FILTER (WHERE overview IS NOT NULL) AS overview,
  arg_min(tagline,ord) FILTER (WHERE tagline IS NOT NULL) AS tagline,
  arg_min(genres,ord) FILTER (WHERE genres IS NOT NULL) AS genres FROM meta GROUP BY id),
  kwf AS (SELECT id, arg_min(keywords,ord) FILTER (WHERE keywords IS NOT NULL) AS keywords FROM kw_rep GROUP BY id),
  crf AS (SELECT id, arg_min(cast_list,ord) FILTER (WHERE cast_list IS NOT NULL) AS cast_list FROM cr_rep GROUP BY id)"""


def names(x: str) -> str:
    quoted = f"""regexp_extract_all({x}, '''name'': (''[^'']*''|"[^"]*")', 1)"""
    return f"list_transform({quoted}, lambda v: v[2:-2])"


def strip(x: str) -> str:
    return f"translate({x}, '{PUNCT}', '')"


def ordered_words(source: str, key: str, value: str) -> str:
    """Distinct words of a list of names in order of appearance, joined."""
    return f"""SELECT {key}, string_agg(w, ' ' ORDER BY p) AS {value} FROM (
      SELECT {key}, w, min(p) AS p FROM (SELECT {key}, unnest(ws) AS w, unnest(range(len(ws))) AS p FROM {source})
      WHERE w<>'' GROUP BY 1,2) GROUP BY 1"""


def rake(name: str, source: str, ident: str, text: str, n: int) -> str:
    stop = ",".join(f"'{w}'" for w in STOPWORDS)
    return f"""{name}_t AS (SELECT {ident}, regexp_extract_all(lower({strip(text)}), '{WORD}') AS ws FROM {source}),
  {name}_w AS (SELECT {ident}, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM {name}_t),
  {name}_p AS (SELECT {ident}, word, pos, sum(CASE WHEN word IN ({stop}) THEN 1 ELSE 0 END) OVER (PARTITION BY {ident} ORDER BY pos) AS ph,
    word IN ({stop}) AS is_stop FROM {name}_w),
  {name}_d AS (SELECT {ident}, word, count(*) OVER (PARTITION BY {ident}, ph) AS len FROM {name}_p WHERE NOT is_stop),
  {name}_s AS (SELECT {ident}, word, CAST(sum(len) AS BIGINT) AS degree FROM {name}_d GROUP BY 1,2),
  {name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {ident} ORDER BY degree DESC, word) AS rank FROM {name}_s) WHERE rank<={n})"""


def bow(min_df: int = 3) -> str:
    return f"""bow AS (SELECT item_id, token, CAST(count(*) AS BIGINT) AS cnt FROM
    (SELECT doc_id AS item_id, unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS token FROM documents) GROUP BY 1,2),
  voc AS (SELECT token, count(*) AS df FROM bow GROUP BY 1 HAVING count(*)>={min_df}),
  bv AS (SELECT item_id, token, cnt FROM bow SEMI JOIN voc USING (token))"""


BOW = bow()
ITEM_SIM = """nm AS (SELECT item_id, sqrt(sum(cnt*cnt)) AS n FROM bv GROUP BY 1),
  dots AS (SELECT a.item_id AS i, b.item_id AS j, CAST(sum(a.cnt*b.cnt) AS DOUBLE) AS dot FROM bv a JOIN bv b USING (token) GROUP BY 1,2),
  isim AS (SELECT x.item_id AS i, y.item_id AS j, coalesce(dot,0)/(x.n*y.n) AS s FROM nm x JOIN nm y ON x.item_id<>y.item_id
    LEFT JOIN dots ON dots.i=x.item_id AND dots.j=y.item_id)"""


def top(source: str, n: int, order: str = "score DESC, item_id", entity: str = "user_id") -> str:
    return f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {entity} ORDER BY {order}) AS rank FROM {source}) WHERE rank<={n}"


# train/test by the newest rating
LOO = """te AS (SELECT user_id, arg_max(item_id,(ts,event_id)) AS item_id, arg_max(rating,(ts,event_id)) AS rating FROM {pool} GROUP BY 1),
  tr AS (SELECT * FROM rt ANTI JOIN te USING (user_id,item_id))"""
NEWEST = LOO.format(pool="rt")


def positives(source: str, threshold: float, m: int, name: str = "pos") -> str:
    """Ratings at or above the threshold, lowered per user until m remain."""
    return f"""{name}_x AS (SELECT user_id, coalesce(max(CASE WHEN rn={m} THEN rating END), min(rating)) AS x FROM
    (SELECT user_id, rating, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC) AS rn FROM {source}) GROUP BY 1),
  {name} AS (SELECT s.*, {threshold}::DOUBLE - 0.5::DOUBLE*greatest(0.0, ceil(({threshold}-x)/0.5))::DOUBLE AS effective FROM {source} s JOIN {name}_x USING (user_id)
    WHERE rating >= {threshold}::DOUBLE - 0.5::DOUBLE*greatest(0.0, ceil(({threshold}-x)/0.5))::DOUBLE)"""


def user_sims(train: str, metric: str = "cosine", tag: str = "") -> str:
    value = "coalesce(dot,0)/(a.n*b.n)" if metric == "cosine" else (
        "1.0/CASE WHEN sqrt(greatest(a.q+b.q-2*coalesce(dot,0),0))=0 THEN 1e-6 ELSE sqrt(greatest(a.q+b.q-2*coalesce(dot,0),0)) END"
    )
    return f"""nt{tag} AS (SELECT user_id, sum(rating*rating) AS q, sqrt(sum(rating*rating)) AS n FROM {train} GROUP BY 1),
  nr{tag} AS (SELECT user_id, sum(rating*rating) AS q, sqrt(sum(rating*rating)) AS n FROM rt GROUP BY 1),
  ud{tag} AS (SELECT a.user_id AS u, b.user_id AS v, sum(a.rating*b.rating) AS dot FROM {train} a JOIN rt b USING (item_id) GROUP BY 1,2),
  us{tag} AS (SELECT a.user_id AS u, b.user_id AS v, {value} AS s FROM nt{tag} a JOIN nr{tag} b ON a.user_id<>b.user_id
    LEFT JOIN ud{tag} d ON d.u=a.user_id AND d.v=b.user_id)"""


def memory_cf(train: str, n: int, name: str = "mem", tag: str = "") -> str:
    return user_sims(train, tag=tag) + f""",
  {name}_den AS (SELECT u, sum(s) AS den FROM us{tag} GROUP BY 1),
  {name}_num AS (SELECT u AS user_id, r.item_id, sum(s*r.rating) AS num FROM us{tag} JOIN rt r ON r.user_id=us{tag}.v GROUP BY 1,2),
  {name}_s AS (SELECT user_id, item_id, {r6('num/(den+1e-6)')} AS score FROM {name}_num JOIN {name}_den ON u=user_id
    ANTI JOIN {train} t USING (user_id,item_id)),
  {name} AS ({top(name + '_s', n)})"""


def weighted_profile(train: str, n: int, name: str = "wp") -> str:
    return f"""{name}_w AS (SELECT user_id, token, sum(rating*cnt) AS w FROM {train} JOIN bv USING (item_id) GROUP BY 1,2),
  {name}_l AS (SELECT user_id, sum(w) AS l FROM {name}_w GROUP BY 1),
  {name}_d AS (SELECT user_id, b.item_id, sum(w*cnt) AS d FROM {name}_w JOIN bv b USING (token) GROUP BY 1,2),
  {name}_s AS (SELECT user_id, item_id, {r6('d/(l+1e-6)')} AS score FROM {name}_d JOIN {name}_l USING (user_id)
    ANTI JOIN {train} t USING (user_id,item_id)),
  {name} AS ({top(name + '_s', n)})"""


def user_knn(train: str, n: int, metric: str = "cosine", name: str = "knn", tag: str = "") -> str:
    return user_sims(train, metric, tag) + f""",
  {name}_n AS (SELECT u, v, row_number() OVER (PARTITION BY u ORDER BY {r6('s')} DESC, v) AS near FROM us{tag}),
  {name}_c AS (SELECT u AS user_id, r.item_id, min(near) AS near, arg_min(r.rating, near) AS score FROM {name}_n JOIN rt r ON r.user_id=v
    ANTI JOIN {train} t ON t.user_id=u AND t.item_id=r.item_id GROUP BY 1,2),
  {name} AS ({top(name + '_c', n, 'greatest(near,10), score DESC, near, item_id')})"""


LEVELS = 6  # the largest item set of the small tables has four items; the last levels stay empty


def _level(k: int) -> str:
    """Frequent sets of k items and who has them, from those of k-1 items."""
    longer = f"u{k - 1} u JOIN u1 f ON f.user_id=u.user_id AND f.last>u.last"
    return f"""s{k} AS MATERIALIZED (SELECT list_append(u.items, f.last) AS items, f.last AS last, count(*) AS freq FROM {longer}
    GROUP BY 1, 2 HAVING count(*)>=0.15*(SELECT n FROM nb)),
  u{k} AS MATERIALIZED (SELECT u.user_id, s.items, s.last FROM {longer} JOIN s{k} s ON s.items=list_append(u.items, f.last))"""


SETS = ",\n  ".join([
    "b AS (SELECT DISTINCT user_id, item_id FROM rt), nb AS (SELECT count(DISTINCT user_id) AS n FROM b)",
    "s1 AS (SELECT [item_id] AS items, item_id AS last, count(*) AS freq FROM b GROUP BY item_id HAVING count(*)>=0.15*(SELECT n FROM nb))",
    "u1 AS (SELECT user_id, items, last FROM b JOIN s1 ON last=item_id)",
    *[_level(k) for k in range(2, LEVELS + 1)],
    "sets AS MATERIALIZED (SELECT items, freq, freq/CAST((SELECT n FROM nb) AS DOUBLE) AS support FROM ("
    + " UNION ALL ".join(f"SELECT items, freq FROM s{k}" for k in range(1, LEVELS + 1)) + "))",
])


def rules(least: float) -> str:
    return SETS + f""",
  sp AS (SELECT items, freq, support, unnest(range(1, (1<<len(items))-1)) AS m FROM sets WHERE len(items)>=2),
  sq AS (SELECT freq, support, list_filter(items, lambda x, i: ((m >> (i-1)) & 1)=1) AS ante,
    list_filter(items, lambda x, i: ((m >> (i-1)) & 1)=0) AS cons FROM sp),
  ru AS (SELECT ante, cons, sq.support, CAST(sq.freq AS DOUBLE)/a.freq AS confidence,
      CAST(sq.freq AS DOUBLE)/a.freq/c.support AS lift, sq.support-a.support*c.support AS leverage,
      CASE WHEN CAST(sq.freq AS DOUBLE)/a.freq<1 THEN (1.0-c.support)/(1.0-CAST(sq.freq AS DOUBLE)/a.freq) END AS conviction
    FROM sq JOIN sets a ON a.items=ante JOIN sets c ON c.items=cons WHERE CAST(sq.freq AS DOUBLE)/a.freq>={least})"""


NEXT = """nx AS (SELECT user_id, item_id, lead(item_id) OVER (PARTITION BY user_id ORDER BY ts,event_id) AS next_item, ts, event_id FROM ev),
  tc AS (SELECT item_id, next_item, count(*) AS cnt FROM nx WHERE next_item IS NOT NULL GROUP BY 1,2),
  tp AS (SELECT item_id, next_item, cnt, CAST(cnt AS DOUBLE)/sum(cnt) OVER (PARTITION BY item_id) AS probability FROM tc)"""
CSCORE = """cs AS (SELECT user_id, cluster, avg(rating) AS mean_rating, count(*) AS n_ratings FROM {train} JOIN cl USING (item_id) GROUP BY 1,2),
  cr AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY mean_rating DESC, n_ratings DESC, cluster) AS rank FROM cs)"""


def cluster_popular(train: str, n: int) -> str:
    return CSCORE.format(train=train) + f""",
  cc AS (SELECT user_id, cl.item_id, cr.rank AS cr, popularity, mean_rating AS score FROM cr JOIN cl USING (cluster)
    ANTI JOIN {train} t ON t.user_id=cr.user_id AND t.item_id=cl.item_id),
  cp AS ({top('cc', n, 'cr, popularity DESC, item_id')})"""


NORMS = """nm AS (SELECT doc_id AS item_id, coalesce(sum(cnt*cnt),0) AS q, sqrt(coalesce(sum(cnt*cnt),0)) AS n
      FROM documents LEFT JOIN bv ON item_id=doc_id GROUP BY 1),
  rated AS (SELECT DISTINCT item_id FROM rt),
  dots AS (SELECT a.item_id AS j, b.item_id AS i, CAST(sum(a.cnt*b.cnt) AS DOUBLE) AS dot FROM bv a SEMI JOIN rated USING (item_id) JOIN bv b USING (token) GROUP BY 1,2)"""


def item_knn(k: int, metric: str, n: int = 10, train: str = "rt", tag: str = "") -> str:
    dist = "CASE WHEN j.n*i.n>0 THEN 1.0-coalesce(dot,0)/(j.n*i.n) ELSE 1.0 END" if metric == "cosine" else (
        "sqrt(greatest(j.q+i.q-2*coalesce(dot,0),0))"
    )
    return f"""ds{tag} AS (SELECT j.item_id AS j, i.item_id AS i, {dist} AS d FROM (SELECT * FROM nm SEMI JOIN rated USING (item_id)) j CROSS JOIN nm i
    LEFT JOIN dots ON dots.j=j.item_id AND dots.i=i.item_id),
  cand{tag} AS (SELECT r.user_id, ds.i AS item_id, r.rating, d, floor(d*1e6+0.5) AS g,
      row_number() OVER (PARTITION BY r.user_id, ds.i ORDER BY floor(d*1e6+0.5), r.item_id) AS rn
    FROM {train} r JOIN ds{tag} ds ON ds.j=r.item_id),
  kn{tag} AS (SELECT user_id, item_id, CASE WHEN min(g)=0 THEN avg(rating) FILTER (WHERE g=0) ELSE sum(rating/d) FILTER (WHERE g>0)/sum(1.0/d) FILTER (WHERE g>0) END AS score
    FROM cand{tag} WHERE rn<={k} GROUP BY 1,2),
  ks{tag} AS (SELECT user_id, item_id, {r6('score')} AS score FROM kn{tag} ANTI JOIN {train} t USING (user_id,item_id)),
  ik{tag} AS ({top('ks' + tag, n)})"""


def _negatives() -> str:
    return f"""ring AS (SELECT item_id, row_number() OVER (ORDER BY item_id) AS pos FROM (SELECT DISTINCT item_id FROM rt)),
  sz AS (SELECT count(*) AS m FROM ring),
  own AS (SELECT user_id, count(*) AS c FROM rt GROUP BY 1),
  pz AS (SELECT min(p) AS p FROM (SELECT unnest(range(greatest(m,2), 2*m+3)) AS p FROM sz)
    WHERE len(list_filter(range(2, CAST(floor(sqrt(p)) AS BIGINT)+1), lambda d: p % d = 0))=0),
  wk AS (SELECT user_id, c, p, {h('user_id', '0', '0')} % p AS o, {h('user_id', '1', '0')} % (p-1) + 1 AS st FROM own, pz),
  st AS (SELECT user_id, c, step, (o + step*st) % p + 1 AS pos FROM (SELECT *, unnest(range(p)) AS step FROM wk)),
  mt AS (SELECT user_id, c, step, item_id FROM st JOIN ring USING (pos) ANTI JOIN rt USING (user_id,item_id)),
  ng AS (SELECT user_id, item_id, CAST(0 AS DOUBLE) AS label FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY step) AS rn FROM mt) WHERE rn<=c)"""


def cluster_samples(train: str, exponential: bool, n: int, runs: str = "range(1)") -> str:
    """Items drawn from a user's clusters: seeded walks around rings of prime size, arrival times from seeded uniforms."""
    weight = "pow(2.0, 1.0+5.0*rating)" if exponential else "rating"
    return f"""cw AS (SELECT user_id, cluster, count(*) AS rated, sum({weight}) AS wt FROM {train} JOIN cl USING (item_id) GROUP BY 1,2),
  cpb AS (SELECT user_id, cluster, rated, {r6('wt/sum(wt) OVER (PARTITION BY user_id)')} AS p FROM cw),
  cring AS (SELECT cluster, item_id, row_number() OVER (PARTITION BY cluster ORDER BY {h('item_id', 'cluster', '17')}, item_id) AS pos FROM cl),
  csz AS (SELECT cluster, max(pos) AS m FROM cring GROUP BY 1),
  cpz AS (SELECT cluster, m, min(q) AS ps FROM (SELECT cluster, m, unnest(range(greatest(m,2), 2*m+3)) AS q FROM csz)
    WHERE len(list_filter(range(2, CAST(floor(sqrt(q)) AS BIGINT)+1), lambda d: q % d = 0))=0 GROUP BY 1,2),
  cwk AS (SELECT user_id, cluster, p, m, ps, seed, {h('user_id', 'cluster', 'seed')} % ps AS o, {h('cluster', 'user_id', 'seed+1')} % (ps-1) + 1 AS st,
      {h('user_id', 'cluster', '5')} AS pair, least(ps, {n}+rated+ps-m) AS need
    FROM cpb JOIN cpz USING (cluster) CROSS JOIN (SELECT unnest({runs}) AS seed) WHERE p>0),
  cst AS (SELECT *, (o + step*st) % ps + 1 AS pos FROM (SELECT *, unnest(range(CAST(need AS BIGINT))) AS step FROM cwk)),
  cnt AS (SELECT *, row_number() OVER (PARTITION BY user_id, seed, cluster ORDER BY step)-1 AS nth FROM cst WHERE pos<=m),
  ctm AS (SELECT *, sum(-ln(({h('pair', 'nth', 'seed+3')}+0.5::DOUBLE)/{MODULUS}.0::DOUBLE)*m/((m-nth)*p)) OVER (PARTITION BY user_id, seed, cluster ORDER BY step) AS t FROM cnt),
  cdr AS (SELECT ctm.user_id, seed, item_id, t FROM ctm JOIN cring USING (cluster, pos) ANTI JOIN {train} s ON s.user_id=ctm.user_id AND s.item_id=cring.item_id),
  csm AS (SELECT user_id, seed, item_id, -t AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id, seed ORDER BY t, item_id) AS rank FROM cdr) WHERE rank<={n})"""


RECS = "user_id, item_id, score, rank"
HITS = "CAST(count(h.item_id) AS BIGINT) AS hits, count(*) AS users, " + r6("CAST(count(h.item_id) AS DOUBLE)/count(*)") + " AS rate"


def w(*parts: str) -> str:
    recursive = "RECURSIVE " if any("FROM sub s" in p for p in parts) else ""
    return f"WITH {recursive}" + ",\n".join(parts[:-1]) + "\n" + parts[-1]


PREDICT = user_sims("tr") + f""",
  pr AS (SELECT te.user_id, te.item_id, te.rating, {r6('coalesce(sum(s*r.rating),0)/(coalesce(sum(s) FILTER (WHERE r.rating IS NOT NULL),0)+1e-6)')} AS predicted
    FROM te JOIN us ON u=te.user_id LEFT JOIN rt r ON r.user_id=v AND r.item_id=te.item_id GROUP BY 1,2,3)"""


def sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_ratings"] = w(EV, "SELECT user_id, item_id, rating, event_id FROM ev")
    q["scan_catalog"] = w(IT, "SELECT * FROM it")
    q["clean_ids"] = w(META, "SELECT id, title, popularity, tagline, genres FROM meta")
    q["rating_triples"] = w(EV, "SELECT user_id, item_id, rating FROM ev")
    q["normalized_ratings"] = w(PU, "SELECT user_id, item_id, rating/5.0::DOUBLE AS rating FROM pu")
    q["ratings_with_metadata"] = w(PU, "SELECT user_id, item_id, rating FROM pu WHERE item_id IN (SELECT doc_id FROM documents)")
    q["rated_catalog"] = w(EV, IT, "SELECT item_id, title, popularity FROM it WHERE item_id IN (SELECT item_id FROM ev)")
    q["positive_ratings"] = w(RT, positives("rt", 5.0, 2), "SELECT user_id, item_id, rating, effective FROM pos")
    q["unseen_items"] = w(
        RT, "c AS (SELECT item_id, count(*) AS c FROM rt GROUP BY 1)",
        "x AS (SELECT u.user_id, c.item_id, c.c FROM (SELECT DISTINCT user_id FROM rt) u CROSS JOIN c ANTI JOIN rt ON rt.user_id=u.user_id AND rt.item_id=c.item_id)",
        f"SELECT user_id, item_id, rank FROM ({top('x', 10, 'c DESC, item_id')})",
    )
    q["item_lookup"] = w(IT, "SELECT item_id, title, popularity, text FROM it WHERE item_id=42")
    q["user_history"] = w(PU, "SELECT user_id, item_id, rating FROM pu ORDER BY 1, 3 DESC, 2")
    q["metadata_outer_join"] = w(
        META, "SELECT id, title, overview, keywords, cast_list AS \"cast\", genres FROM meta FULL JOIN kw USING (id) FULL JOIN cr USING (id)"
    )
    q["recs_with_titles"] = w(
        RT, memory_cf("rt", 5), "SELECT user_id, rank, item_id, p_name AS title FROM mem LEFT JOIN part ON p_partkey=item_id"
    )
    q["item_popularity"] = w(
        EV, META, FIRST, "SELECT item_id, popularity FROM (SELECT DISTINCT item_id FROM ev) JOIN mf ON mf.id=item_id"
    )
    q["candidate_pairs"] = w(
        RT, "pl AS (SELECT doc_id AS item_id, row_number() OVER (ORDER BY doc_id) AS pos FROM documents)",
        "x AS (SELECT u.user_id, pos FROM (SELECT DISTINCT user_id FROM rt) u CROSS JOIN pl ANTI JOIN rt ON rt.user_id=u.user_id AND rt.item_id=pl.item_id)",
        "y AS (SELECT user_id, pos, pos - row_number() OVER (PARTITION BY user_id ORDER BY pos) AS island FROM x)",
        "SELECT user_id, min(pos) AS first_pos, max(pos) AS last_pos, count(*) AS n_items FROM y GROUP BY user_id, island",
    )
    q["metadata_first"] = w(META, FIRST, "SELECT id, title, popularity, overview, tagline, genres FROM mf")
    q["user_rating_totals"] = w(PU, "SELECT user_id, sum(rating) AS rating_sum, count(*) AS n_ratings FROM pu GROUP BY 1")
    stats = f"st AS (SELECT item_id, count(*) AS n_ratings, {r6('avg(rating)')} AS mean_rating FROM pu GROUP BY 1)"
    q["most_rated_items"] = w(PU, stats, "SELECT * FROM st ORDER BY n_ratings DESC, item_id LIMIT 10")
    q["top_rated_items"] = w(PU, stats, "SELECT * FROM st ORDER BY mean_rating DESC, item_id LIMIT 10")
    q["distinct_by_month"] = w(
        EV, "SELECT strftime(ts, '%Y-%m') AS period, count(DISTINCT user_id) AS user_id, count(DISTINCT item_id) AS item_id, "
        "TRUE AS user_id_within, TRUE AS item_id_within FROM ev GROUP BY 1"
    )
    q["bucketed_history"] = w(
        RT, "SELECT user_id, item_id, rating, count(*) OVER u AS n_ratings, sum(rating) OVER u AS rating_sum FROM rt WINDOW u AS (PARTITION BY user_id)"
    )
    q["rating_profile"] = w(
        EV, "SELECT count(user_id) AS n_user_id, count(item_id) AS n_item_id, count(rating) AS n_rating, count(ts) AS n_ts, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items FROM ev"
    )
    q["dedup_catalog"] = w(
        META, "SELECT id, title, popularity, overview, genres FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ord) AS rn FROM meta) WHERE rn=1"
    )
    q["duplicate_ids"] = w(META, "SELECT id, count(*) AS occurrences FROM meta_raw GROUP BY 1 HAVING count(*)>1")
    q["latest_rating"] = w(RT, "SELECT user_id, item_id, rating, event_id FROM rt")
    q["user_baskets"] = w(
        RT, "SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items, count(*) AS n_items FROM rt GROUP BY 1"
    )
    q["vocabulary"] = w(BOW, "SELECT token, df FROM voc")
    q["dense_ids"] = w(EV, "SELECT user_id, row_number() OVER (ORDER BY min(event_id))-1 AS dense_id FROM ev GROUP BY 1")
    q["loo_newest"] = w(RT, NEWEST, "SELECT user_id, item_id, rating FROM te")
    q["loo_random"] = w(
        RT, f"SELECT user_id, arg_min(item_id,(hh,item_id)) AS item_id, arg_min(rating,(hh,item_id)) AS rating FROM (SELECT *, {h('user_id', 'item_id', '30')} AS hh FROM rt) GROUP BY 1"
    )
    flagged = "SELECT s.user_id, s.item_id, s.rating, te.user_id IS NOT NULL AS is_test FROM {pool} s LEFT JOIN te ON te.user_id=s.user_id AND te.item_id=s.item_id"
    q["loo_split"] = w(RT, NEWEST, flagged.format(pool="rt"))
    q["loo_positive_split"] = w(RT, positives("rt", 5.0, 1), LOO.format(pool="pos"), flagged.format(pool="rt"))
    q["per_user_training_rows"] = w(RT, positives("rt", 4.0, 2), LOO.format(pool="pos"), flagged.format(pool="pos"))
    q["split_80_20"] = w(PU, f"SELECT user_id, item_id, rating, {h('user_id', 'item_id', '123')} % 10 >= 8 AS is_test FROM pu")
    q["parse_names"] = w(META, f"SELECT id, array_to_string({names('cast_list')}, '|') AS names FROM cr")
    q["clean_keywords"] = w(
        META, f"k AS (SELECT id, string_split(lower({strip('array_to_string(' + names('keywords') + ', chr(10))')}), ' ') AS ws0 FROM kw)",
        "k2 AS (SELECT id, regexp_split_to_array(array_to_string(ws0,' '), '\\s+') AS ws FROM k)",
        ordered_words("k2", "id", "keywords"),
    )
    q["clean_elements"] = w(
        META, f"SELECT id, array_to_string(list_transform({names('cast_list')}, lambda v: replace(lower({strip('v')}),' ','')), ' ') AS \"cast\" FROM cr"
    )
    q["text_keywords"] = w(
        f"src AS (SELECT doc_id, replace(text, '{NO_OVERVIEW}', '') AS text FROM documents)", rake("rk", "src", "doc_id", "text", 7),
        "SELECT doc_id, word, degree, rank FROM rk",
    )
    merged = f"""mg AS (SELECT id, title, popularity, replace(overview, '{NO_OVERVIEW}', '') AS overview, tagline, genres, keywords, cast_list
      FROM mf FULL JOIN kwf USING (id) FULL JOIN crf USING (id))"""

    def elements(x: str) -> str:
        return f"nullif(array_to_string(list_transform({names(x)}, lambda v: replace(lower({strip('v')}),' ','')), ' '), '')"

    combined = (
        META, FIRST, merged, rake("ov", "mg", "id", "coalesce(overview,'')", 7), rake("tg", "mg", "id", "coalesce(tagline,'')", 3),
        "ovs AS (SELECT id, string_agg(word,' ' ORDER BY rank) AS overview FROM ov GROUP BY 1)",
        "tgs AS (SELECT id, string_agg(word,' ' ORDER BY rank) AS tagline FROM tg GROUP BY 1)",
        f"k2 AS (SELECT id, regexp_split_to_array(lower({strip('array_to_string(' + names('keywords') + ', chr(10))')}), '\\s+') AS ws FROM kwf)",
        "kws AS (" + ordered_words("k2", "id", "keywords") + ")",
        f"""cf AS (SELECT mg.id, mg.title, concat_ws(' ', ovs.overview, tgs.tagline, kws.keywords, {elements('mg.cast_list')}, {elements('mg.genres')}) AS combined
          FROM mg LEFT JOIN ovs USING (id) LEFT JOIN tgs USING (id) LEFT JOIN kws USING (id))""",
    )
    q["combined_features"] = w(*combined, "SELECT id, title, combined FROM cf")
    feature_bow = (
        f"bow AS (SELECT id AS item_id, token, count(*) AS cnt FROM (SELECT id, unnest(regexp_extract_all(lower(combined), '{TOKEN}')) AS token FROM cf) GROUP BY 1,2)",
        "voc AS (SELECT token FROM bow GROUP BY 1 HAVING count(*)>=3), bv AS (SELECT item_id, token, cnt FROM bow SEMI JOIN voc USING (token))",
    )
    q["similar_feature_items"] = w(
        *combined, *feature_bow, ITEM_SIM, f"x AS (SELECT i AS item_id, j AS similar_id, {r6('s')} AS score FROM isim)",
        f"SELECT item_id, similar_id, score, rank FROM ({top('x', 3, 'score DESC, similar_id', 'item_id')})",
    )
    q["feature_profile_recs"] = w(RT, *combined, *feature_bow, weighted_profile("rt", 10), f"SELECT {RECS} FROM wp")
    q["feature_sink"] = q["combined_features"]
    q["bag_of_words"] = w(BOW, "SELECT item_id AS doc_id, token, cnt FROM bow")
    summary = "count(*) FILTER (WHERE s>0) AS n_similar, " + r6("sum(s)") + " AS sim_sum, " + r6("max(s)") + " AS sim_max"
    q["user_cosine"] = w(RT, user_sims("rt"), f"SELECT u AS user_id, {summary} FROM us GROUP BY 1")
    q["item_cosine"] = w(BOW, ITEM_SIM, f"SELECT i AS item_id, {summary} FROM isim GROUP BY 1")
    q["similar_user_pairs"] = w(
        RT, user_sims("rt"), f"SELECT u AS user_id, v AS neighbor_id, {r6('s')} AS similarity FROM us WHERE {r6('s')}>=0.45::DOUBLE"
    )
    q["similar_item_pairs"] = w(
        BOW, ITEM_SIM, f"SELECT i AS item_id, j AS similar_id, {r6('s')} AS similarity FROM isim WHERE {r6('s')}>=0.8::DOUBLE"
    )
    for name, metric in (("user_neighbors", "cosine"), ("user_euclidean", "euclidean")):
        q[name] = w(
            RT, user_sims("rt", metric), f"x AS (SELECT u AS user_id, v AS neighbor_id, {r6('s')} AS similarity FROM us)",
            f"SELECT user_id, neighbor_id, similarity, rank FROM ({top('x', 10, 'similarity DESC, neighbor_id')})",
        )
    close = f"x AS (SELECT i AS item_id, j AS similar_id, {r6('s')} AS score FROM isim), sm AS ({top('x', 3, 'score DESC, similar_id', 'item_id')})"
    q["similar_items"] = w(BOW, ITEM_SIM, close, "SELECT item_id, similar_id, score, rank FROM sm")
    q["similar_items_report"] = w(
        BOW, ITEM_SIM, close,
        f"rp AS (SELECT item_id, {r6('avg(score)')} AS avg_similarity, string_agg(p_name, ' | ' ORDER BY rank) AS most_similar FROM sm LEFT JOIN part ON p_partkey=similar_id GROUP BY 1)",
        "SELECT item_id, p_name AS title, avg_similarity, most_similar FROM rp LEFT JOIN part ON p_partkey=item_id ORDER BY avg_similarity DESC, item_id LIMIT 30",
    )
    q["user_profile"] = w(
        RT, BOW, "pw AS (SELECT user_id, token, sum(rating*cnt) AS w FROM rt JOIN bv USING (item_id) GROUP BY 1,2)",
        f"SELECT user_id, token, {r6('w/(sum(w) OVER (PARTITION BY user_id)+1e-6)')} AS weight FROM pw",
    )
    q["weighted_user_features"] = w(
        RT, bow(20), f"SELECT user_id, token, {r6('sum(rating/5.0::DOUBLE*cnt)')} AS weight FROM rt JOIN bv USING (item_id) GROUP BY 1,2"
    )
    q["nearest_to_centroid"] = w(
        "e AS (SELECT vec_id, CAST(label AS BIGINT) AS cluster, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS dim FROM embeddings)",
        "c AS (SELECT cluster, dim, avg(x) AS m FROM e GROUP BY 1,2)",
        f"x AS (SELECT c.cluster, vec_id AS item_id, {r6('sum((x-m)*(x-m))')} AS distance FROM e JOIN c USING (dim) GROUP BY 1,2)",
        f"SELECT cluster, item_id, distance, rank FROM ({top('x', 10, 'distance, item_id', 'cluster')})",
    )
    q["memory_cf_recs"] = w(RT, memory_cf("rt", 10), f"SELECT {RECS} FROM mem")
    q["memory_cf_predict"] = w(RT, NEWEST, PREDICT, "SELECT user_id, item_id, rating, predicted FROM pr")
    q["memory_cf_predict_topk"] = w(
        RT, NEWEST, user_sims("tr"),
        f"n0 AS (SELECT u, v, {r6('s')} AS s FROM us UNION ALL SELECT DISTINCT user_id, user_id, 1.0 FROM tr)",
        "n1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY s DESC, v) AS rn FROM n0) WHERE rn<=20 AND u<>v)",
        f"""SELECT te.user_id, te.item_id, te.rating, {r6('coalesce(sum(s*r.rating),0)/(coalesce(sum(s) FILTER (WHERE r.rating IS NOT NULL),0)+1e-6)')} AS predicted
          FROM te LEFT JOIN n1 ON u=te.user_id LEFT JOIN rt r ON r.user_id=v AND r.item_id=te.item_id GROUP BY 1,2,3""",
    )
    q["scaled_mse"] = w(
        RT, NEWEST, PREDICT, "sp AS (SELECT min(rating) r0, max(rating) r1, min(predicted) p0, max(predicted) p1 FROM pr)",
        f"""SELECT {r6('avg(pow((rating-r0)/(CASE WHEN r1=r0 THEN 1 ELSE r1-r0 END) - (predicted-p0)/(CASE WHEN p1=p0 THEN 1 ELSE p1-p0 END), 2))')} AS mse, count(*) AS n FROM pr, sp""",
    )
    q["user_knn_recs"] = w(RT, user_knn("rt", 10), f"SELECT {RECS} FROM knn")
    q["user_knn_euclid_recs"] = w(RT, user_knn("rt", 10, "euclidean"), f"SELECT {RECS} FROM knn")
    q["item_knn_recs"] = w(RT, BOW, NORMS, item_knn(5, "cosine"), f"SELECT {RECS} FROM ik")
    q["item_knn_euclid_recs"] = w(RT, BOW, NORMS, item_knn(50, "minkowski"), f"SELECT {RECS} FROM ik")
    q["weighted_profile_recs"] = w(RT, BOW, weighted_profile("rt", 10), f"SELECT {RECS} FROM wp")
    q["frequent_itemsets"] = w(RT, SETS, f"SELECT array_to_string(items,',') AS items, freq, {r6('support')} AS support FROM sets")
    q["itemsets_with_titles"] = w(
        RT, SETS, "x AS (SELECT array_to_string(items,',') AS itemset, freq, unnest(items) AS item_id FROM sets)",
        "SELECT itemset, freq, string_agg(t, ' | ' ORDER BY t) AS titles FROM (SELECT itemset, freq, coalesce(p_name, CAST(item_id AS VARCHAR)) AS t FROM x LEFT JOIN part ON p_partkey=item_id) GROUP BY 1,2",
    )
    q["association_rules"] = w(
        RT, rules(0.2), "SELECT array_to_string(ante,',') AS antecedents, array_to_string(cons,',') AS consequents, "
        + ", ".join(f"{r6(c)} AS {c}" for c in ("support", "confidence", "lift", "leverage", "conviction")) + " FROM ru",
    )
    q["rule_count_by_confidence"] = w(
        RT, rules(0.1), "SELECT CAST(t AS DOUBLE) AS min_confidence, count(confidence) AS rules FROM (VALUES (0.6),(0.4),(0.3),(0.2),(0.15),(0.1)) v(t) LEFT JOIN ru ON confidence>=CAST(t AS DOUBLE) GROUP BY 1"
    )
    q["rule_recs"] = w(
        RT, rules(0.2), "rn AS (SELECT row_number() OVER () AS id, ante, cons, lift FROM ru)",
        "ua AS (SELECT u.user_id, rn.id, unnest(ante) AS item_id, len(ante) AS k FROM rn CROSS JOIN (SELECT DISTINCT user_id FROM rt) u)",
        "sc AS (SELECT ua.user_id, id, sum(coalesce(rt.rating,0))/any_value(k) AS m FROM ua LEFT JOIN rt ON rt.user_id=ua.user_id AND rt.item_id=ua.item_id GROUP BY 1,2)",
        f"co AS (SELECT user_id, item_id, {r6('max(m*lift)')} AS score FROM (SELECT user_id, m, lift, unnest(cons) AS item_id FROM sc JOIN rn USING (id)) GROUP BY 1,2)",
        "al AS (SELECT u.user_id, i.item_id, score FROM (SELECT DISTINCT user_id FROM rt) u CROSS JOIN (SELECT DISTINCT item_id FROM rt) i LEFT JOIN co ON co.user_id=u.user_id AND co.item_id=i.item_id ANTI JOIN rt ON rt.user_id=u.user_id AND rt.item_id=i.item_id)",
        f"SELECT user_id, item_id, coalesce(score,0)::DOUBLE AS score, rank FROM ({top('al', 10, 'coalesce(score,-1) DESC, item_id')})",
    )
    q["cluster_scores"] = w(RT, CL, CSCORE.format(train="rt"), f"SELECT user_id, cluster, {r6('mean_rating')} AS mean_rating, n_ratings, rank FROM cr")
    q["cluster_popularity"] = w(CL, "SELECT cluster, item_id, popularity, row_number() OVER (PARTITION BY cluster ORDER BY popularity DESC, item_id) AS rank FROM cl")
    q["cluster_probabilities"] = w(
        RT, CL, "x AS (SELECT user_id, cluster, count(*) AS rated, sum(rating) AS l, sum(pow(2.0, 1.0+5.0*rating)) AS e FROM rt JOIN cl USING (item_id) GROUP BY 1,2)",
        f"SELECT user_id, cluster, rated, {r6('l/sum(l) OVER (PARTITION BY user_id)')} AS p_linear, {r6('e/sum(e) OVER (PARTITION BY user_id)')} AS p_exponential FROM x",
    )
    q["cluster_popular_recs"] = w(RT, CL, cluster_popular("rt", 10), f"SELECT user_id, item_id, {r6('score')} AS score, rank FROM cp")
    for name, exponential in (("cluster_sample_recs", False), ("cluster_sample_exponential_recs", True)):
        q[name] = w(RT, CL, cluster_samples("rt", exponential, 10), f"SELECT user_id, item_id, {r6('score')} AS score, rank FROM csm")
    q["hit_rate_repeated"] = w(
        RT, NEWEST, CL, cluster_samples("tr", False, 30, "range(10)"),
        f"SELECT {r6('count(*)/10.0::DOUBLE')} AS mean_hits FROM csm SEMI JOIN te ON te.user_id=csm.user_id AND te.item_id=csm.item_id",
    )
    q["markov_transitions"] = w(EV, NEXT, f"SELECT item_id, next_item, cnt, {r6('probability')} AS probability FROM tp")
    q["markov_recs"] = w(
        EV, NEXT, "la AS (SELECT user_id, arg_max(item_id,(ts,event_id)) AS last FROM ev GROUP BY 1)",
        "x AS (SELECT la.user_id, next_item AS item_id, probability AS score FROM la JOIN tp ON tp.item_id=last ANTI JOIN ev ON ev.user_id=la.user_id AND ev.item_id=tp.next_item)",
        f"SELECT user_id, item_id, {r6('score')} AS score, rank FROM ({top('x', 10)})",
    )
    q["trajectory_recs"] = w(
        EV, "e AS (SELECT vec_id AS item_id, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS dim FROM embeddings)",
        "sq AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back, lead(item_id) OVER (PARTITION BY user_id ORDER BY ts,event_id) AS nxt FROM ev SEMI JOIN embeddings ON vec_id=item_id)",
        "sv AS (SELECT user_id, a.dim, avg(b.x-a.x) AS d FROM sq JOIN e a ON a.item_id=sq.item_id JOIN e b ON b.item_id=nxt AND b.dim=a.dim WHERE nxt IS NOT NULL GROUP BY 1,2)",
        "tg AS (SELECT sq.user_id, e.dim, e.x+coalesce(d,0) AS t FROM sq JOIN e ON e.item_id=sq.item_id LEFT JOIN sv ON sv.user_id=sq.user_id AND sv.dim=e.dim WHERE back=1)",
        f"x AS (SELECT user_id, item_id, {r6('-sqrt(sum((t-x)*(t-x)))')} AS score FROM tg JOIN e USING (dim) ANTI JOIN ev USING (user_id,item_id) GROUP BY 1,2)",
        f"SELECT {RECS} FROM ({top('x', 10)})",
    )
    q["negative_samples"] = w(RT, _negatives(), "SELECT user_id, item_id, label FROM ng")
    q["training_pairs"] = w(RT, _negatives(), "SELECT user_id, item_id, rating/5.0::DOUBLE AS label FROM rt UNION ALL SELECT user_id, item_id, label FROM ng")
    two = (memory_cf("rt", 50), weighted_profile("rt", 50))
    q["hybrid_average"] = w(
        RT, BOW, *two, f"x AS (SELECT user_id, item_id, {r6('avg(rank-1)')} AS score FROM (SELECT user_id,item_id,rank FROM mem UNION ALL SELECT user_id,item_id,rank FROM wp) GROUP BY 1,2)",
        f"SELECT {RECS} FROM ({top('x', 10, 'score, item_id')})",
    )
    q["hybrid_predicate"] = w(
        RT, BOW, *two, "a AS (SELECT user_id,item_id,rank,0 AS m FROM mem UNION ALL SELECT user_id,item_id,rank,1 FROM wp)",
        "k AS (SELECT user_id, item_id, m, row_number() OVER (PARTITION BY user_id, m ORDER BY rank) AS p FROM a WHERE (user_id+item_id)%2=m)",
        "f1 AS (SELECT user_id, item_id, min((p,m)) AS pm FROM k GROUP BY 1,2)",
        f"SELECT user_id, item_id, CAST(pm[1] AS DOUBLE) AS score, rank FROM ({top('f1', 10, 'pm')})",
    )
    hit = f"SELECT {HITS} FROM te LEFT JOIN {{m}} h ON h.user_id=te.user_id AND h.item_id=te.item_id"
    q["hit_rate"] = w(RT, NEWEST, memory_cf("tr", 30), hit.format(m="mem"))
    parts, rows = [RT], []
    for t, (threshold, pool) in enumerate(((None, "rt"), (4.0, "pos"))):
        if threshold is not None:
            parts.append(positives("rt", threshold, 1))
        split = LOO.format(pool=pool).replace("te AS", f"te{t} AS").replace("JOIN te ", f"JOIN te{t} ").replace("tr AS", f"tr{t} AS")
        parts.append(split)
        for metric in ("cosine", "euclidean"):
            tag = f"{t}{metric[0]}"
            parts.append(user_knn(f"tr{t}", 30, metric, f"knn{tag}", tag))
            shown = "NULL" if threshold is None else str(threshold)
            rows.append(
                f"SELECT '{metric}' AS metric, CAST({shown} AS DOUBLE) AS threshold, {HITS} FROM te{t} te LEFT JOIN knn{tag} h ON h.user_id=te.user_id AND h.item_id=te.item_id"
            )
    q["hit_rate_grid"] = w(*parts, " UNION ALL ".join(rows))
    parts, rows = [RT, BOW, NORMS], []
    for t, threshold in enumerate((4.0, None)):
        pool = "rt"
        if threshold is not None:
            parts.append(positives("rt", threshold, 2))
            pool = "pos"
        test, train = LOO.format(pool=pool).split("\n  tr AS")
        parts.append(test.replace("te AS", f"te{t} AS").rstrip(","))
        parts.append(f"tr{t} AS (SELECT user_id, item_id, rating FROM {pool} ANTI JOIN te{t} USING (user_id,item_id))")
        for metric in ("cosine", "minkowski"):
            tag = f"{t}{metric[0]}"
            parts.append(item_knn(50, metric, 30, f"tr{t}", tag))
            shown = "NULL" if threshold is None else str(threshold)
            rows.append(
                f"SELECT '{metric}' AS metric, CAST({shown} AS DOUBLE) AS threshold, {HITS} FROM te{t} te LEFT JOIN ik{tag} h ON h.user_id=te.user_id AND h.item_id=te.item_id"
            )
    q["hit_rate_item_grid"] = w(*parts, " UNION ALL ".join(rows))
    four = (
        BOW, memory_cf("tr", 50), weighted_profile("tr", 50), user_knn("tr", 30, tag="k"),
        f"hx AS (SELECT user_id, item_id, {r6('avg(rank-1)')} AS score FROM (SELECT user_id,item_id,rank FROM mem UNION ALL SELECT user_id,item_id,rank FROM wp) GROUP BY 1,2)",
        f"hy AS ({top('hx', 30, 'score, item_id')})",
        " UNION ALL ".join(
            f"SELECT '{name}' AS method, {HITS} FROM te LEFT JOIN (SELECT * FROM {m} WHERE rank<=30) h ON h.user_id=te.user_id AND h.item_id=te.item_id"
            for name, m in (("memory_cf", "mem"), ("user_knn", "knn"), ("weighted_profile", "wp"), ("average_hybrid", "hy"))
        ),
    )
    q["method_comparison"] = w(RT, NEWEST, *four)
    q["method_comparison_positive"] = w(RT, positives("rt", 4.0, 1), LOO.format(pool="pos"), *four)
    q["recommendation_report"] = w(
        RT, NEWEST, CL, cluster_popular("tr", 30),
        "a AS (SELECT user_id, 'rated' AS section, item_id, rating AS score FROM tr UNION ALL SELECT user_id, 'recommended', item_id, CAST(rank AS DOUBLE) FROM cp UNION ALL SELECT user_id, 'test', item_id, rating FROM te)",
        "SELECT user_id, section, item_id, coalesce(p_name, CAST(item_id AS VARCHAR)) AS title, score FROM a LEFT JOIN part ON p_partkey=item_id",
    )
    return q

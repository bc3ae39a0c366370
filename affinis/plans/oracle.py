"""Oracle SQL (DuckDB dialect) for the registered queries.

Written as direct, naive SQL over the driver's tables: global windows,
per-threshold recomputation, correlated counts.  It is the independent
reference the Spark plans are checked against at small scale.  Every
double that is a sum of doubles is rounded to 9 digits on both sides;
everything else is integer arithmetic and one division, so values match
bit for bit.
"""

from __future__ import annotations

import re

from affinis.operators.models import FIXED_WEIGHTS

H = "CAST(CAST(('0x' || substr(md5(concat_ws('|', {keys})), 1, 13)) AS BIGINT) AS DOUBLE) / CAST(4503599627370496 AS DOUBLE)"


def h(*keys: str) -> str:
    return "(" + H.format(keys=", ".join(keys)) + ")"


WC = ("(CASE WHEN {t} IS NULL THEN 0 WHEN {t} = '' THEN 1 "
      "WHEN regexp_replace({t}, '[^\\w'']+$', '') = '' THEN 0 "
      "ELSE CAST(len(string_split_regex(regexp_replace({t}, '[^\\w'']+$', ''), '[^\\w'']+')) AS INTEGER) END)")


def wc(t: str) -> str:
    return WC.format(t=t)


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


CTE: dict[str, str] = {}

CTE["posts"] = f"""
SELECT p.p_partkey AS post_id,
       CAST(regexp_extract(d.source, '[0-9]+', 0) AS BIGINT) AS blog_id,
       CAST(p.p_size AS BIGINT) AS author_id,
       d.lang AS language,
       regexp_extract(d.text, '^[^\\n.]*', 0) AS title,
       CAST(length(d.text) AS INTEGER) AS content_chars,
       list_distinct([p.p_type, p.p_brand]) AS categories,
       list_distinct(list_transform(string_split(p.p_name, ' '), lambda w: w || '-' || p.topic)) AS tags
FROM (SELECT *, CAST(p_partkey % (SELECT greatest(1, count(*) // 24) FROM part) AS VARCHAR) AS topic FROM part) p JOIN documents d ON d.doc_id = p.p_partkey % (SELECT count(*) FROM documents)"""

CTE["all_likes"] = """
SELECT o.o_custkey AS user_id, l.l_partkey AS post_id, min(o.o_orderdate) AS ts
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2"""
CTE["stats_likes"] = "SELECT user_id, post_id FROM all_likes WHERE ts < TIMESTAMP '1999-01-01 00:00:00'"
CTE["train_likes"] = ("SELECT user_id, post_id FROM all_likes WHERE ts >= TIMESTAMP '1999-01-01 00:00:00' "
                      "AND ts < TIMESTAMP '2000-07-01 00:00:00'")
CTE["test_likes"] = "SELECT user_id, post_id FROM all_likes WHERE ts >= TIMESTAMP '2000-07-01 00:00:00'"
CTE["stats_ub"] = """
SELECT s.user_id, p.blog_id, count(*) AS likes
FROM stats_likes s JOIN posts p ON p.post_id = s.post_id GROUP BY 1, 2"""
CTE["stats_user"] = """
SELECT user_id, blog_id, likes, CAST(sum(likes) OVER (PARTITION BY user_id) AS BIGINT) AS num_likes FROM stats_ub"""
CTE["stats_blog"] = """
SELECT np.blog_id, CAST(coalesce(nl.num_likes, 0) AS BIGINT) AS num_likes, np.num_posts
FROM (SELECT blog_id, count(*) AS num_posts FROM posts GROUP BY 1) np
LEFT JOIN (SELECT p.blog_id, count(*) AS num_likes FROM stats_likes s JOIN posts p ON p.post_id = s.post_id GROUP BY 1) nl
  ON nl.blog_id = np.blog_id"""
CTE["truth"] = "SELECT DISTINCT user_id, post_id FROM test_likes"
CTE["test_users"] = "SELECT DISTINCT user_id FROM test_likes"

# ---- profiles -------------------------------------------------------------------------------
CTE["liked_posts"] = "SELECT t.user_id, p.* FROM train_likes t JOIN posts p ON p.post_id = t.post_id"
CTE["prof_raw"] = f"""
SELECT user_id, 'category' AS kind, key, count(*) AS cnt FROM (SELECT user_id, unnest(categories) AS key FROM liked_posts) GROUP BY 1, 2, 3
UNION ALL SELECT user_id, 'tag', key, count(*) FROM (SELECT user_id, unnest(tags) AS key FROM liked_posts) GROUP BY 1, 2, 3
UNION ALL SELECT user_id, 'language', language, count(*) FROM liked_posts GROUP BY 1, 2, 3
UNION ALL SELECT user_id, 'author', CAST(author_id AS VARCHAR), count(*) FROM liked_posts GROUP BY 1, 2, 3
UNION ALL SELECT user_id, 'title_len', CAST({wc('title')} AS VARCHAR), count(*) FROM liked_posts GROUP BY 1, 2, 3"""


def _prof_capped(cap: int) -> str:
    return f"""
SELECT user_id, kind, key, cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, kind ORDER BY cnt DESC, key) AS rn FROM prof_raw)
WHERE kind NOT IN ('category', 'tag', 'author') OR rn <= {cap}"""


CTE["profile"] = "SELECT user_id, kind, key, cnt FROM prof_raw"
CTE["profile_100"] = _prof_capped(100)
CTE["profile_small"] = _prof_capped(3)
CTE["user_totals"] = """
SELECT user_id,
  CAST(sum(CASE WHEN kind = 'category' THEN cnt END) AS BIGINT) AS tot_category,
  CAST(sum(CASE WHEN kind = 'tag' THEN cnt END) AS BIGINT) AS tot_tag,
  CAST(sum(CASE WHEN kind = 'language' THEN cnt END) AS BIGINT) AS tot_language,
  CAST(sum(CASE WHEN kind = 'author' THEN cnt END) AS BIGINT) AS tot_author,
  CAST(sum(CASE WHEN kind = 'title_len' THEN cnt END) AS BIGINT) AS tl_sum,
  count(CASE WHEN kind = 'title_len' THEN 1 END) AS tl_n,
  CAST(sum(CASE WHEN kind = 'title_len' THEN cnt * CAST(key AS BIGINT) END) AS BIGINT) AS tl_wsum
FROM profile GROUP BY user_id"""
CTE["own_stats"] = """
SELECT * FROM stats_user WHERE user_id IN (SELECT user_id FROM stats_user GROUP BY user_id HAVING count(*) < 1000)"""
CTE["own_totals"] = "SELECT user_id, CAST(sum(likes) AS BIGINT) AS blog_total FROM stats_user GROUP BY 1"
CTE["blog_likes"] = "SELECT blog_id, CAST(sum(likes) AS BIGINT) AS blog_likes FROM stats_user GROUP BY 1"
CTE["post_attrs"] = f"""
SELECT p.post_id, p.blog_id, p.author_id, p.language, p.categories, p.tags, {wc('p.title')} AS title_len,
  bl.blog_likes,
  CASE WHEN sb.blog_id IS NOT NULL THEN {div('sb.num_likes', 'sb.num_posts')}
       ELSE (SELECT {div('sum(num_likes)', 'sum(num_posts)')} FROM stats_blog) END AS avg_likes_per_post
FROM posts p LEFT JOIN blog_likes bl ON bl.blog_id = p.blog_id LEFT JOIN stats_blog sb ON sb.blog_id = p.blog_id"""
CTE["prof_all"] = ("SELECT user_id, kind, key, cnt FROM profile UNION ALL "
                   "SELECT user_id, 'blog', CAST(blog_id AS VARCHAR), likes FROM stats_user")


def features_cte(pairs: str, name: str, variant: str = "coded", keep: str = "") -> None:
    """Register CTE ``name`` = the seven features of the pairs in CTE ``pairs``."""
    kp = f", q.{keep}" if keep else ""
    kq = f", pf.{keep}" if keep else ""
    CTE[f"{name}_pf"] = f"""
SELECT q.user_id, q.post_id{kp}, ut.* EXCLUDE (user_id), pa.* EXCLUDE (post_id)
FROM {pairs} q JOIN user_totals ut ON ut.user_id = q.user_id JOIN post_attrs pa ON pa.post_id = q.post_id"""
    CTE[f"{name}_m"] = f"""
SELECT lab.user_id, lab.post_id,
  sum(DISTINCT CASE WHEN lab.kind = 'category' THEN pr.cnt END) AS cat_sd,
  sum(CASE WHEN lab.kind = 'category' THEN pr.cnt END) AS cat_s,
  sum(DISTINCT CASE WHEN lab.kind = 'tag' THEN pr.cnt END) AS tag_sd,
  sum(CASE WHEN lab.kind = 'tag' THEN pr.cnt END) AS tag_s,
  max(CASE WHEN lab.kind = 'language' THEN pr.cnt END) AS lang_cnt,
  max(CASE WHEN lab.kind = 'author' THEN pr.cnt END) AS author_cnt,
  max(CASE WHEN lab.kind = 'blog' THEN pr.cnt END) AS own_blog_likes
FROM (
  SELECT user_id, post_id, 'category' AS kind, unnest(categories) AS key FROM {name}_pf
  UNION ALL SELECT user_id, post_id, 'tag', unnest(tags) FROM {name}_pf
  UNION ALL SELECT user_id, post_id, 'language', language FROM {name}_pf
  UNION ALL SELECT user_id, post_id, 'author', CAST(author_id AS VARCHAR) FROM {name}_pf
  UNION ALL SELECT user_id, post_id, 'blog', CAST(blog_id AS VARCHAR) FROM {name}_pf
) lab JOIN prof_all pr ON pr.user_id = lab.user_id AND pr.kind = lab.kind AND pr.key = lab.key
GROUP BY 1, 2"""
    coded = variant == "coded"
    cat = "cat_sd" if coded else "cat_s"
    tag = "tag_sd" if coded else "tag_s"
    tl = div("pf.tl_sum", "pf.tl_n") if coded else div("pf.tl_wsum", "pf.tl_sum")
    CTE[name] = f"""
SELECT pf.user_id, pf.post_id{kq},
  {div(f'coalesce(m.{cat}, 0)', 'pf.tot_category')} AS categories_likelihood,
  {div(f'coalesce(m.{tag}, 0)', 'pf.tot_tag')} AS tags_likelihood,
  {div('coalesce(m.lang_cnt, 0)', 'pf.tot_language')} AS language_likelihood,
  {div('coalesce(m.author_cnt, 0)', 'pf.tot_author')} AS author_likelihood,
  abs({tl} - pf.title_len) AS title_length_error,
  CASE WHEN ot.blog_total IS NOT NULL THEN {div('coalesce(m.own_blog_likes, 0)', 'ot.blog_total')}
       ELSE {div('coalesce(pf.blog_likes, 0)', '(SELECT sum(blog_likes) FROM blog_likes)')} END AS blog_likelihood,
  pf.avg_likes_per_post
FROM {name}_pf pf LEFT JOIN {name}_m m ON m.user_id = pf.user_id AND m.post_id = pf.post_id
LEFT JOIN own_totals ot ON ot.user_id = pf.user_id"""


features_cte("train_likes", "feat_true")
features_cte("train_likes", "feat_true_doc", "documented")

# ---- negatives ------------------------------------------------------------------------------
CTE["universe"] = "SELECT DISTINCT user_id FROM train_likes"
CTE["user_index"] = "SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS idx FROM universe"
CTE["lpp"] = """
SELECT p.post_id, count(t.user_id) AS n_likes FROM posts p LEFT JOIN train_likes t ON t.post_id = p.post_id GROUP BY 1"""
CTE["dist_bins"] = "SELECT CAST(b AS INTEGER) AS bin FROM range(0, 100) r(b)"
CTE["dist"] = """
SELECT bin, bin AS n_users, cnt,
  CAST(coalesce(sum(cnt) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS lo,
  CAST(coalesce(sum(cnt) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS BIGINT) AS hi
FROM (SELECT db.bin, count(x.post_id) AS cnt FROM dist_bins db
      LEFT JOIN (SELECT post_id, least(n_likes, 99) AS bin FROM lpp WHERE n_likes <= 100) x ON x.bin = db.bin
      GROUP BY db.bin)"""
CTE["dist_all"] = """
SELECT n_likes AS n_users, CAST(sum(count(*)) OVER (ORDER BY n_likes) - count(*) AS BIGINT) AS lo,
  CAST(sum(count(*)) OVER (ORDER BY n_likes) AS BIGINT) AS hi, count(*) AS cnt FROM lpp GROUP BY n_likes"""
CTE["neg_counts"] = f"""
SELECT r.post_id, r.n_likes, coalesce(d.n_users, 0) AS n_neg FROM (
  SELECT post_id, n_likes, floor({h('42', "'n'", 'post_id')} * (SELECT sum(cnt) FROM dist_all)) AS r FROM lpp) r
LEFT JOIN dist_all d ON r.r >= d.lo AND r.r < d.hi"""
CTE["draws"] = f"""
SELECT post_id, n_likes, k, floor({h('42', "'u'", 'post_id', 'k')} * m) AS j FROM (
  SELECT post_id, n_likes, m, unnest(range(n_neg)) AS k FROM (
    SELECT post_id, n_likes, n_neg, (SELECT count(*) FROM universe) - n_likes AS m FROM neg_counts) WHERE m > 0 AND n_neg > 0)"""
CTE["liked_g"] = """
SELECT t.post_id, ui.idx, ui.idx - (row_number() OVER (PARTITION BY t.post_id ORDER BY ui.idx) - 1) AS g
FROM train_likes t JOIN user_index ui ON ui.user_id = t.user_id"""
CTE["picks"] = """
SELECT d.post_id, d.k, CAST(d.j + (SELECT count(*) FROM liked_g l WHERE l.post_id = d.post_id AND l.g <= d.j) AS BIGINT) AS idx
FROM draws d"""
CTE["neg_pairs"] = "SELECT DISTINCT ui.user_id, p.post_id FROM picks p JOIN user_index ui ON ui.idx = p.idx"
features_cte("neg_pairs", "feat_false")
CTE["training"] = ("SELECT *, CAST(1.0 AS DOUBLE) AS label FROM feat_true UNION ALL "
                   "SELECT *, CAST(0.0 AS DOUBLE) AS label FROM feat_false")

# ---- candidates -----------------------------------------------------------------------------
CTE["sampled"] = f"""
SELECT user_id FROM (SELECT user_id, {h('42', 'user_id')} AS hh FROM test_users) WHERE hh < 0.1
ORDER BY hh, user_id LIMIT 100"""
CTE["tposts"] = "SELECT * FROM posts WHERE post_id IN (SELECT post_id FROM truth)"
CTE["tag_index"] = ("SELECT DISTINCT key AS tag, user_id FROM profile WHERE kind = 'tag' "
                    "AND user_id IN (SELECT user_id FROM test_users)")
CTE["cands"] = """
SELECT DISTINCT ti.user_id, pt.post_id FROM (SELECT DISTINCT post_id, unnest(tags) AS tag FROM tposts) pt
JOIN tag_index ti ON ti.tag = pt.tag"""
CTE["labelled"] = """
SELECT c.user_id, c.post_id, CASE WHEN t.user_id IS NOT NULL THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS label
FROM cands c LEFT JOIN truth t ON t.user_id = c.user_id AND t.post_id = c.post_id
WHERE c.user_id IN (SELECT user_id FROM truth)"""
features_cte("labelled", "feat_cand", keep="label")
CTE["scored"] = ("SELECT user_id, post_id, label, tags_likelihood AS score FROM feat_cand "
                 "WHERE tags_likelihood IS NOT NULL AND NOT isnan(tags_likelihood)")

# ---- ranking --------------------------------------------------------------------------------
CTE["ranked_all"] = """
SELECT r.user_id, r.k, r.post_id, r.score, CASE WHEN t.user_id IS NOT NULL THEN 1 ELSE 0 END AS hit
FROM (SELECT user_id, post_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, post_id) AS k
      FROM scored) r
LEFT JOIN truth t ON t.user_id = r.user_id AND t.post_id = r.post_id"""
CTE["ranked_hits"] = """
SELECT user_id, k, post_id, score, hit,
  CAST(sum(hit) OVER (PARTITION BY user_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_hits FROM ranked_all"""
CTE["truth_sizes"] = "SELECT user_id, count(*) AS n_truth FROM truth GROUP BY 1"
CTE["ap_users"] = """
SELECT h.user_id, sum(h.hit * h.cum_hits / h.k) / least(ts.n_truth, 100) AS ap
FROM ranked_hits h JOIN truth_sizes ts ON ts.user_id = h.user_id WHERE h.k <= 100 GROUP BY h.user_id, ts.n_truth"""


def grid_cte(name: str, scored: str, lo: int, hi: int, step: int) -> None:
    CTE[f"{name}_g"] = f"SELECT CAST(t AS DOUBLE) / 100 AS threshold FROM range({lo}, {hi + 1}, {step}) r(t)"
    CTE[f"{name}_r"] = f"""
SELECT g.threshold, s.user_id, s.post_id,
  row_number() OVER (PARTITION BY g.threshold, s.user_id ORDER BY s.score DESC, s.post_id) AS k,
  CASE WHEN t.user_id IS NOT NULL THEN 1 ELSE 0 END AS hit
FROM {name}_g g JOIN {scored} s ON s.score >= g.threshold
LEFT JOIN truth t ON t.user_id = s.user_id AND t.post_id = s.post_id"""
    CTE[f"{name}_ap"] = f"""
SELECT threshold, user_id, sum(hit * cum / k) / least(n_truth, 100) AS ap FROM (
  SELECT r.*, sum(hit) OVER (PARTITION BY threshold, r.user_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS cum, ts.n_truth
  FROM {name}_r r JOIN truth_sizes ts ON ts.user_id = r.user_id WHERE k <= 100)
GROUP BY threshold, user_id, n_truth"""
    CTE[name] = f"""
SELECT g.threshold, round(coalesce(avg(a.ap), 0), 9) AS map, count(a.user_id) AS n_users
FROM {name}_g g LEFT JOIN {name}_ap a ON a.threshold = g.threshold GROUP BY g.threshold"""


grid_cte("tag_grid", "scored", 1, 100, 1)
grid_cte("tag_grid2", "scored", 1, 100, 2)

# ---- curves ---------------------------------------------------------------------------------
CTE["conf0"] = """
SELECT score AS threshold, CAST(sum(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
  CAST(sum(CASE WHEN label > 0.5 THEN 0 ELSE 1 END) AS BIGINT) AS neg FROM scored GROUP BY score"""
CTE["class_sizes"] = """
SELECT CAST(sum(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS p,
  CAST(sum(CASE WHEN label > 0.5 THEN 0 ELSE 1 END) AS BIGINT) AS n FROM feat_cand"""
CTE["conf"] = """
SELECT threshold,
  CAST(sum(pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp,
  CAST(sum(neg) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp,
  pos, neg, row_number() OVER (ORDER BY threshold DESC) - 1 AS position,
  (SELECT p FROM class_sizes) AS n_pos, (SELECT n FROM class_sizes) AS n_neg
FROM conf0"""
CTE["pts"] = f"""
SELECT threshold, position, {div('tp', 'tp + fp')} AS precision, {div('tp', 'n_pos')} AS recall,
  {div('fp', 'n_neg')} AS fpr, {div('tp', 'n_pos')} AS tpr FROM conf"""
CTE["roc_pts"] = """
SELECT CAST(NULL AS DOUBLE) AS threshold, CAST(0.0 AS DOUBLE) AS fpr, CAST(0.0 AS DOUBLE) AS tpr, CAST(0 AS BIGINT) AS position
UNION ALL SELECT NULL, CAST(1.0 AS DOUBLE), CAST(1.0 AS DOUBLE), (SELECT count(*) + 1 FROM pts)
UNION ALL SELECT threshold, fpr, tpr, position + 1 FROM pts"""
CTE["pr_pts"] = """
SELECT CAST(NULL AS DOUBLE) AS threshold, CAST(0.0 AS DOUBLE) AS recall, precision, position FROM pts WHERE position = 0
UNION ALL SELECT threshold, recall, precision, position + 1 FROM pts"""


def _fm(b2: float) -> str:
    return (f"CASE WHEN precision + recall = 0 THEN CAST(0.0 AS DOUBLE) ELSE "
            f"(CAST({1.0 + b2!r} AS DOUBLE) * (precision * recall)) / (CAST({b2!r} AS DOUBLE) * precision + recall) END")


Q: dict[str, str] = {}

POST_DISPLAY = """SELECT post_id, blog_id, author_id, language, title,
  array_to_string(list_sort(list_distinct(categories)), ',') AS categories,
  array_to_string(list_sort(list_distinct(tags)), ',') AS tags, content_chars FROM posts"""
FEAT_COLS = ("categories_likelihood, tags_likelihood, language_likelihood, author_likelihood, "
             "title_length_error, blog_likelihood, avg_likes_per_post")

Q["src_stats_blog"] = "SELECT blog_id, num_likes, num_posts FROM stats_blog"
Q["src_stats_user_long"] = "SELECT user_id, blog_id, likes, num_likes FROM stats_user"
Q["src_stats_users"] = "SELECT user_id, max(num_likes) AS num_likes FROM stats_user GROUP BY user_id"
Q["src_posts"] = POST_DISPLAY
Q["src_likes"] = "SELECT user_id, post_id FROM train_likes"
Q["src_test_posts"] = POST_DISPLAY
Q["src_truth"] = "SELECT user_id, post_id FROM truth"
Q["src_user_list"] = "SELECT user_id FROM test_users"
Q["tsv_train_roundtrip"] = f"SELECT label, {FEAT_COLS} FROM training"
Q["parquet_train_roundtrip"] = Q["tsv_train_roundtrip"]
Q["parquet_test_roundtrip"] = f"SELECT user_id, post_id, {FEAT_COLS} FROM feat_cand"
Q["profile_merged"] = "SELECT user_id, kind, key, cnt FROM prof_raw"
Q["label_pairs_dropped"] = """SELECT count(*) FILTER (user_id IN (SELECT user_id FROM truth)) AS n_labelled,
  count(*) FILTER (user_id NOT IN (SELECT user_id FROM truth)) AS n_dropped
FROM (SELECT user_id, post_id FROM cands UNION SELECT user_id, post_id FROM train_likes)"""
Q["tsv_test_roundtrip"] = f"SELECT user_id, post_id, {FEAT_COLS} FROM feat_cand"

CTE["faulty_posts"] = """
SELECT post_id, blog_id, author_id, CASE WHEN post_id % 7 = 3 THEN NULL ELSE title END AS title, content_chars, categories,
  CASE WHEN post_id % 17 = 4 THEN NULL ELSE tags END AS tags,
  CASE WHEN post_id % 13 = 6 THEN NULL WHEN post_id % 11 = 5 THEN '' ELSE language END AS language FROM posts"""
CTE["faulty_features"] = """
SELECT * REPLACE (CASE WHEN (user_id + post_id) % 9 = 0 THEN 'NaN'::DOUBLE WHEN (user_id + post_id) % 10 = 0 THEN 'Infinity'::DOUBLE
  WHEN (user_id + post_id) % 11 = 0 THEN NULL ELSE tags_likelihood END AS tags_likelihood) FROM training"""
Q["filter_any_null"] = ("SELECT post_id, blog_id, author_id, language, title FROM faulty_posts WHERE post_id IS NOT NULL "
                        "AND blog_id IS NOT NULL AND author_id IS NOT NULL AND language IS NOT NULL AND title IS NOT NULL "
                        "AND content_chars IS NOT NULL AND categories IS NOT NULL AND tags IS NOT NULL")
Q["project_post_sets"] = """SELECT post_id, blog_id, author_id,
  array_to_string(list_sort(list_distinct(categories)), ',') AS categories,
  array_to_string(list_sort(list_distinct(tags)), ',') AS tags, CAST(len(list_distinct(tags)) AS INTEGER) AS n_tags FROM posts"""
Q["stats_user_map"] = "SELECT user_id, blog_id, likes FROM stats_user"
Q["filter_finite_features"] = (f"SELECT user_id, post_id, {FEAT_COLS}, label FROM faulty_features WHERE "
                               + " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c}) AND NOT isinf({c})"
                                              for c in FEAT_COLS.split(", ")))
Q["check_user_totals"] = ("SELECT count(*) AS n_mismatch FROM (SELECT user_id, sum(likes) AS s, max(num_likes) "
                          "+ CASE WHEN user_id % 13 = 0 THEN 1 ELSE 0 END AS n FROM stats_user GROUP BY 1) WHERE s <> n")
Q["check_empty_language"] = "SELECT count(*) AS n_empty_language FROM faulty_posts WHERE length(language) = 0"
Q["lookup_post"] = "SELECT post_id, blog_id, author_id, language, title FROM posts WHERE blog_id = 3 AND post_id = 3"
Q["check_null_fields"] = "SELECT " + ", ".join(
    f"CAST(count(*) - count({c}) AS BIGINT) AS null_{c}"
    for c in ["post_id", "blog_id", "author_id", "language", "title", "content_chars", "categories", "tags"]) + " FROM faulty_posts"
Q["user_blog_likelihood_capped"] = f"SELECT user_id, blog_id, {div('likes', 'num_likes')} AS likelihood FROM own_stats"
Q["user_blog_likelihood_capped_small"] = f"""SELECT user_id, blog_id, {div('likes', 'num_likes')} AS likelihood
FROM stats_user WHERE user_id IN (SELECT user_id FROM stats_user GROUP BY user_id HAVING count(*) < 15)"""
Q["title_word_count"] = f"SELECT post_id, {wc('title')} AS title_words FROM posts"

Q["feature_avg_likes_per_post"] = "SELECT post_id, avg_likes_per_post FROM post_attrs"
Q["feature_blog_likelihood"] = "SELECT user_id, post_id, blog_likelihood FROM feat_true"
Q["semi_test_posts"] = "SELECT post_id, blog_id, author_id, language FROM tposts"
Q["candidate_pairs"] = "SELECT user_id, post_id FROM cands"
Q["check_users_no_stats"] = ("SELECT count(*) AS n_users_no_stats FROM (SELECT DISTINCT user_id FROM train_likes) u "
                             "WHERE user_id NOT IN (SELECT user_id FROM stats_user)")
Q["check_blogs_no_stats"] = ("SELECT count(*) AS n_blogs_no_stats FROM (SELECT DISTINCT blog_id FROM posts) b "
                             "WHERE blog_id NOT IN (SELECT blog_id FROM stats_blog)")
Q["check_blogs_with_stats"] = ("SELECT count(*) AS n_blogs_with_stats FROM (SELECT DISTINCT blog_id FROM posts) b "
                               "WHERE blog_id IN (SELECT blog_id FROM stats_blog)")
Q["label_pairs"] = """
SELECT c.user_id, c.post_id, CASE WHEN t.user_id IS NOT NULL THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS label
FROM (SELECT user_id, post_id FROM cands UNION SELECT user_id, post_id FROM train_likes) c
LEFT JOIN truth t ON t.user_id = c.user_id AND t.post_id = c.post_id WHERE c.user_id IN (SELECT user_id FROM truth)"""
Q["non_like_users"] = "SELECT post_id, n_likes, (SELECT count(*) FROM universe) - n_likes AS n_non_like FROM lpp"

Q["prior_blog_likelihood"] = f"""SELECT blog_id, {div('blog_likes', '(SELECT sum(n) FROM (SELECT max(num_likes) AS n FROM stats_user GROUP BY user_id))')} AS prior
FROM blog_likes"""
Q["mean_blog_likes"] = f"SELECT {div('sum(num_likes)', 'sum(num_posts)')} AS mean_likes_per_post FROM stats_blog"
Q["blog_avg_likes"] = f"SELECT blog_id, {div('num_likes', 'num_posts')} AS avg_likes_per_post FROM stats_blog"
Q["user_blog_likelihood"] = f"SELECT user_id, blog_id, {div('likes', 'num_likes')} AS likelihood FROM stats_user"
Q["profile_categories"] = "SELECT user_id, key AS category, cnt FROM prof_raw WHERE kind = 'category'"
Q["profile_tags"] = "SELECT user_id, key AS tag, cnt FROM prof_raw WHERE kind = 'tag'"
Q["profile_languages"] = "SELECT user_id, key AS language, cnt FROM prof_raw WHERE kind = 'language'"
Q["profile_authors"] = "SELECT user_id, CAST(key AS BIGINT) AS author_id, cnt FROM prof_raw WHERE kind = 'author'"
Q["profile_title_lengths"] = "SELECT user_id, CAST(key AS INTEGER) AS title_len, cnt FROM prof_raw WHERE kind = 'title_len'"
Q["feature_categories_likelihood"] = "SELECT user_id, post_id, categories_likelihood FROM feat_true"
Q["feature_tags_likelihood"] = "SELECT user_id, post_id, tags_likelihood FROM feat_true"
Q["feature_categories_likelihood_plain"] = "SELECT user_id, post_id, categories_likelihood FROM feat_true_doc"
Q["feature_tags_likelihood_plain"] = "SELECT user_id, post_id, tags_likelihood FROM feat_true_doc"
Q["feature_language_likelihood"] = "SELECT user_id, post_id, language_likelihood FROM feat_true"
Q["feature_author_likelihood"] = "SELECT user_id, post_id, author_likelihood FROM feat_true"
Q["feature_title_length_error"] = "SELECT user_id, post_id, title_length_error FROM feat_true"
Q["feature_title_length_error_mean"] = "SELECT user_id, post_id, title_length_error FROM feat_true_doc"
CTE["user_num_likes"] = "SELECT user_id, max(num_likes) AS num_likes FROM stats_user GROUP BY 1"
Q["hist_equal_width"] = """
WITH mm AS (SELECT CAST(min(num_likes) AS DOUBLE) AS lo, CAST(max(num_likes) AS DOUBLE) AS hi FROM user_num_likes),
b AS (SELECT CAST(CASE WHEN mm.hi = mm.lo THEN 0 ELSE least(floor((CAST(num_likes AS DOUBLE) - mm.lo) / (mm.hi - mm.lo) * 25.0), 24) END AS INTEGER) AS bin
      FROM user_num_likes, mm)
SELECT CAST(r.i AS INTEGER) AS bin, (SELECT lo FROM mm) + r.i * (((SELECT hi FROM mm) - (SELECT lo FROM mm)) / 25.0) AS lo_edge,
  count(b.bin) AS cnt
FROM range(0, 25) r(i) LEFT JOIN b ON b.bin = r.i GROUP BY r.i"""
Q["hist_edges"] = """
SELECT CAST(r.i AS INTEGER) AS bin, CAST(r.i AS DOUBLE) AS lo_edge, CAST(r.i + 1 AS DOUBLE) AS hi_edge, count(x.bin) AS cnt
FROM range(0, 24) r(i) LEFT JOIN (SELECT least(num_likes, 23) AS bin FROM user_num_likes WHERE num_likes BETWEEN 0 AND 24) x
  ON x.bin = r.i GROUP BY r.i"""
Q["count_distinct_keys"] = """SELECT (SELECT count(DISTINCT user_id) FROM stats_user) AS n_stats_users,
  (SELECT count(DISTINCT user_id) FROM train_likes) AS n_like_users,
  (SELECT count(DISTINCT blog_id) FROM posts) AS n_post_blogs, (SELECT count(*) FROM stats_blog) AS n_stats_blogs"""
Q["universe_users"] = "SELECT user_id FROM universe"
Q["tag_user_index"] = "SELECT tag, user_id FROM tag_index"
Q["recommend_lists"] = """SELECT user_id, CAST((k - 1) // 100 AS INTEGER) AS part, count(*) AS n_recs,
  string_agg(CAST(post_id AS VARCHAR), ' ' ORDER BY k) AS recs FROM ranked_all GROUP BY 1, 2"""
Q["ap_at_k"] = "SELECT user_id, round(ap, 9) AS ap FROM ap_users"
Q["map_at_k"] = "SELECT round(coalesce(avg(ap), 0), 9) AS map, count(*) AS n_users FROM ap_users"
Q["map_at_k_all_truth"] = ("SELECT round(coalesce(avg(coalesce(a.ap, 0)), 0), 9) AS map, count(*) AS n_users "
                           "FROM truth_sizes t LEFT JOIN ap_users a ON a.user_id = t.user_id")
Q["likes_per_post_distribution"] = "SELECT bin, n_users, cnt, lo, hi FROM dist"
Q["best_map_threshold"] = "SELECT threshold, map FROM tag_grid2 ORDER BY map DESC, threshold ASC LIMIT 1"
Q["best_threshold_min_fpr"] = ("SELECT threshold, fpr, tpr FROM pts WHERE tpr > 0.7 "
                               "ORDER BY fpr ASC, threshold DESC LIMIT 1")
Q["best_threshold_max_tpr"] = ("SELECT threshold, fpr, tpr FROM pts WHERE fpr < 0.1 "
                               "ORDER BY tpr DESC, threshold DESC LIMIT 1")
Q["ranked_hits"] = "SELECT user_id, k, post_id, score, hit, cum_hits FROM ranked_hits"
Q["confusion_by_threshold"] = "SELECT threshold, tp, fp, pos, neg, position, n_pos, n_neg FROM conf"
Q["profile_topk"] = "SELECT user_id, kind, key, cnt FROM profile_100 WHERE kind IN ('category', 'tag', 'author')"
Q["profile_topk_small"] = "SELECT user_id, kind, key, cnt FROM profile_small WHERE kind IN ('category', 'tag', 'author')"
Q["top_categories"] = """SELECT category, count(*) AS cnt FROM (SELECT unnest(categories) AS category FROM posts)
GROUP BY 1 ORDER BY cnt DESC, category LIMIT 25"""
Q["preview"] = "SELECT user_id, post_id, label FROM labelled ORDER BY user_id, post_id LIMIT 10"
Q["training_set"] = f"SELECT user_id, post_id, {FEAT_COLS}, label FROM training"
Q["features_true"] = f"SELECT user_id, post_id, {FEAT_COLS} FROM feat_true"
Q["features_false"] = f"SELECT user_id, post_id, {FEAT_COLS} FROM feat_false"
Q["features_candidates"] = f"SELECT user_id, post_id, label, {FEAT_COLS} FROM feat_cand"
Q["sample_test_users"] = "SELECT user_id FROM sampled"
Q["negative_counts"] = "SELECT post_id, n_likes, n_neg FROM neg_counts"
Q["negative_pairs"] = "SELECT user_id, post_id FROM neg_pairs"
Q["split_train_holdout"] = f"""SELECT user_id, post_id, label,
  CASE WHEN {h('42', "'s'", 'user_id', 'post_id')} < 0.8 THEN 'train' ELSE 'holdout' END AS split FROM training"""
Q["check_test_users_without_profile"] = ("SELECT count(*) AS n_users_no_profile FROM test_users "
                                         "WHERE user_id NOT IN (SELECT user_id FROM user_totals)")
Q["tag_scores"] = "SELECT user_id, post_id, label, tags_likelihood AS score FROM feat_cand"
Q["precision_by_threshold"] = "SELECT threshold, precision FROM pts"
Q["recall_by_threshold"] = "SELECT threshold, recall FROM pts"
Q["pr_curve"] = "SELECT threshold, recall, precision, position FROM pr_pts"
Q["f_measure_by_threshold"] = f"SELECT threshold, {_fm(1.0)} AS f1, {_fm(0.25)} AS f05 FROM pts"
Q["area_under_pr"] = """SELECT round(sum((recall - prev_r) * (precision + prev_p) / 2.0), 9) AS area_under_pr FROM (
  SELECT recall, precision,
    lag(recall) OVER (ORDER BY threshold DESC NULLS FIRST) AS prev_r, lag(precision) OVER (ORDER BY threshold DESC NULLS FIRST) AS prev_p
  FROM pr_pts) WHERE prev_r IS NOT NULL"""
Q["roc_curve"] = "SELECT threshold, fpr, tpr, position FROM roc_pts"
Q["area_under_roc"] = """SELECT round(sum((fpr - prev_f) * (tpr + prev_t) / 2.0), 9) AS area_under_roc FROM (
  SELECT fpr, tpr, lag(fpr, 1, 0.0) OVER (ORDER BY threshold DESC) AS prev_f, lag(tpr, 1, 0.0) OVER (ORDER BY threshold DESC) AS prev_t
  FROM pts)"""
Q["map_threshold_grid"] = "SELECT threshold, map, n_users FROM tag_grid"
Q["curve_percentile_bins"] = """SELECT round(avg(threshold), 9) AS x, round(avg(precision), 9) AS y FROM (
  SELECT threshold, precision, floor(position / ((SELECT count(*) FROM pts) / CAST(24.0 AS DOUBLE)) + 0.5) AS g FROM pts)
GROUP BY g"""
Q["curve_linear_bins"] = """WITH mm AS (SELECT min(fpr) AS lo, max(fpr) AS hi FROM roc_pts)
SELECT round(avg(fpr), 9) AS x, round(avg(tpr), 9) AS y FROM (
  SELECT fpr, tpr, CASE WHEN mm.hi = mm.lo THEN 0 ELSE floor((fpr - mm.lo) / ((mm.hi - mm.lo) / CAST(24.0 AS DOUBLE)) + 0.5) END AS g
  FROM roc_pts, mm) GROUP BY g"""
Q["curve_round_x"] = """SELECT floor(threshold * CAST(100.0 AS DOUBLE) + 0.5) / CAST(100.0 AS DOUBLE) AS x, round(avg(precision), 9) AS y
FROM pts GROUP BY 1"""


def _thin(points: str, by: str, digits: int) -> str:
    """A thinned curve: averages by index or by x, then x rounded half up."""
    size = "(SELECT count(*) FROM c)"
    group = {"index": f"floor(position / ({size} / CAST(24.0 AS DOUBLE)) + 0.5)",
             "linear": "CASE WHEN hi = lo THEN 0 ELSE floor((x - lo) / ((hi - lo) / CAST(24.0 AS DOUBLE)) + 0.5) END"}[by]
    scale = f"CAST({10 ** digits} AS DOUBLE)"
    return f"""WITH c AS ({points}), r AS (SELECT min(x) AS lo, max(x) AS hi FROM c),
t AS (SELECT round(avg(x), 9) AS x, round(avg(y), 9) AS y FROM (SELECT x, y, {group} AS g FROM c, r) GROUP BY g)
SELECT floor(x * {scale} + 0.5) / {scale} AS x, round(avg(y), 9) AS y FROM t GROUP BY 1"""


_PRECISION = "SELECT threshold AS x, precision AS y, position FROM pts"
Q["curve_thin_precision_linear"] = _thin(_PRECISION, "linear", 2)
Q["curve_thin_precision"] = _thin(_PRECISION, "index", 2)
Q["curve_thin_recall"] = _thin("SELECT threshold AS x, recall AS y, position FROM pts", "index", 2)
Q["curve_thin_pr"] = _thin("SELECT recall AS x, precision AS y, position FROM pr_pts", "index", 4)
Q["curve_thin_f1"] = _thin(f"SELECT threshold AS x, {_fm(1.0)} AS y, position FROM pts", "index", 3)
Q["curve_thin_f05"] = _thin(f"SELECT threshold AS x, {_fm(0.25)} AS y, position FROM pts", "index", 3)
Q["curve_thin_roc"] = _thin("SELECT fpr AS x, tpr AS y, position FROM roc_pts", "linear", 3)


# ---- the stored model: fixed weights, then the same evaluation as the tag scorer ---------------
_WEIGHTS = dict(zip(FEAT_COLS.split(", "), FIXED_WEIGHTS, strict=True))
_Z = "CAST(0.0 AS DOUBLE)" + "".join(f" + CAST({w!r} AS DOUBLE) * {f}" for f, w in _WEIGHTS.items())
_FINITE = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c}) AND NOT isinf({c})" for c in _WEIGHTS)
CTE["stored_all"] = f"""SELECT user_id, post_id, label,
  CASE WHEN {_FINITE} THEN round(1.0 / (1.0 + exp(-({_Z}))), 9) END AS score FROM feat_cand"""
CTE["stored_scored"] = "SELECT * FROM stored_all WHERE score IS NOT NULL"
_EVALUATED = ["scored", "conf0", "conf", "pts", "roc_pts", "pr_pts"]


def _of_stored(text: str) -> str:
    return re.sub(rf"\b({'|'.join(_EVALUATED)})\b", r"stored_\1", text)


for _n in _EVALUATED[1:]:
    CTE[f"stored_{_n}"] = _of_stored(CTE[_n])
grid_cte("stored_grid", "stored_scored", 50, 100, 2)
Q["assemble_features"] = f"SELECT user_id, post_id, {', '.join(f'CASE WHEN NOT isnan({c}) THEN {c} END AS {c}' for c in _WEIGHTS)} FROM feat_cand"
Q["stored_weights"] = ("SELECT * FROM (VALUES " + ", ".join(f"('{f}', CAST({w!r} AS DOUBLE))" for f, w in [*_WEIGHTS.items(), ("intercept", 0.0)])
                       + ") v(feature, weight)")
Q["stored_scores"] = "SELECT user_id, post_id, label, score FROM stored_all"
Q["stored_map_grid"] = "SELECT threshold, map, n_users FROM stored_grid"
Q["stored_best_map_threshold"] = "SELECT threshold, map FROM stored_grid ORDER BY map DESC, threshold ASC LIMIT 1"
for _q in ["precision_by_threshold", "recall_by_threshold", "pr_curve", "f_measure_by_threshold", "roc_curve", "area_under_pr",
           "area_under_roc", "best_threshold_min_fpr", "best_threshold_max_tpr"]:
    Q[f"stored_{_q}"] = _of_stored(Q[_q])
Q["stored_confusion"] = _of_stored(Q["confusion_by_threshold"])
for _q in [q for q in Q if q.startswith("curve_thin_")]:
    Q[f"stored_{_q.removeprefix('curve_')}"] = _of_stored(Q[_q])
# the loss, its mean derivatives and the features' deviations by their definitions
CTE["fit_rows"] = f"SELECT *, {_Z} AS z, 1.0 / (1.0 + exp(-({_Z}))) - label AS miss FROM training WHERE {_FINITE}"
_PENALTY = " + ".join(f"var_samp({f}) * CAST({w!r} AS DOUBLE) * CAST({w!r} AS DOUBLE)" for f, w in _WEIGHTS.items())
Q["loss_gradient"] = " UNION ALL ".join(
    [f"""SELECT 'loss' AS term, round(avg(CASE WHEN label > 0.5 THEN ln(1.0 + exp(-z)) ELSE z + ln(1.0 + exp(-z)) END)
  + 0.005 * ({_PENALTY}), 9) AS value FROM fit_rows""", "SELECT 'intercept', round(avg(miss), 9) FROM fit_rows"]
    + [f"SELECT '{f}', round(avg(miss * {f}) + 0.01 * var_samp({f}) * CAST({w!r} AS DOUBLE), 9) FROM fit_rows" for f, w in _WEIGHTS.items()])


def _deps(text: str) -> list[str]:
    return [n for n in CTE if re.search(rf"\b{re.escape(n)}\b", text)]


def _with(body: str) -> str:
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str, stack: tuple = ()) -> None:
        if name in seen:
            return
        for d in _deps(CTE[name]):
            if d != name and d not in stack:
                visit(d, stack + (name,))
        seen.add(name)
        order.append(name)

    for d in _deps(body):
        visit(d)
    if not order:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n].strip()})" for n in order) + "\n" + body.strip()


def _merge_with(body: str) -> str:
    """Prepend the shared CTEs a body needs; a body with its own WITH keeps it after them."""
    b = body.strip()
    own = b.upper().startswith("WITH ")
    inner = b[5:].strip() if own else b
    full = _with(inner)
    if not full.startswith("WITH ") or full == inner:
        return b
    head = full[: len(full) - len(inner)].rstrip("\n")
    return head + (",\n" if own else "\n") + inner


def oracle_sql() -> dict[str, str]:
    return {k: _merge_with(v) for k, v in Q.items()}

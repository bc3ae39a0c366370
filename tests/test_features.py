"""Profiles and the seven features on the hand-computed case of FIXTURES C2."""

import pytest

from affinis.operators import features as FE
from affinis.operators import profiles as PR

POSTS = [
    (1, 1, 10, "en", "Hello, big world", "", ["A", "B"], ["x", "y"]),
    (2, 1, 11, "en", "don't stop", "", ["A"], ["x"]),
    (3, 2, 10, "fr", "!wow", "", ["C"], ["y", "z"]),
    (4, 3, 12, "en", "", "", ["A", "B", "C"], ["x", "y"]),
]
POSTS_SCHEMA = ("post_id bigint, blog_id bigint, author_id bigint, language string, title string, "
                "content string, categories array<string>, tags array<string>")
LIKES = [(1, 1), (2, 1), (1, 2), (1, 3)]     # (user, post)
STATS_USER = [(1, 1, 3, 4), (1, 2, 1, 4), (3, 3, 1, 2), (3, 1, 1, 2)]
STATS_BLOG = [(1, 6, 3), (2, 1, 0)]


@pytest.fixture(scope="module")
def tables(spark):
    posts = spark.createDataFrame(POSTS, POSTS_SCHEMA)
    likes = spark.createDataFrame(LIKES, "user_id bigint, post_id bigint")
    su = spark.createDataFrame(STATS_USER, "user_id bigint, blog_id bigint, likes bigint, num_likes bigint")
    sb = spark.createDataFrame(STATS_BLOG, "blog_id bigint, num_likes bigint, num_posts bigint")
    return posts, likes, su, sb


def _feats(spark, tables, variant):
    posts, likes, su, sb = tables
    ctx = FE.build_context(posts, likes, su, sb)
    pairs = spark.createDataFrame([(1, 4), (2, 4)], "user_id bigint, post_id bigint")
    return {r.user_id: r for r in FE.pair_features(pairs, ctx, variant=variant).collect()}


def test_features_as_coded(spark, tables):
    f = _feats(spark, tables, "coded")
    u1, u2 = f[1], f[2]
    assert u1.categories_likelihood == pytest.approx(3 / 4)
    assert u1.tags_likelihood == pytest.approx(2 / 5)
    assert u1.language_likelihood == pytest.approx(2 / 3)
    assert u1.author_likelihood == 0.0
    assert u1.title_length_error == pytest.approx(0.5)
    assert u1.blog_likelihood == 0.0
    assert u1.avg_likes_per_post == pytest.approx(7 / 3)
    assert u2.categories_likelihood == pytest.approx(1 / 2)
    assert u2.tags_likelihood == pytest.approx(1 / 2)
    assert u2.language_likelihood == 1.0
    assert u2.title_length_error == 0.0
    assert u2.blog_likelihood == pytest.approx(1 / 6)
    assert u2.avg_likes_per_post == pytest.approx(7 / 3)


def test_features_as_documented(spark, tables):
    f = _feats(spark, tables, "documented")
    assert f[1].categories_likelihood == pytest.approx(1.0)
    assert f[1].tags_likelihood == pytest.approx(4 / 5)
    assert f[1].title_length_error == pytest.approx(4 / 3)
    assert f[2].categories_likelihood == pytest.approx(1.0)
    assert f[2].title_length_error == pytest.approx(2.0)


def test_priors_and_blog_averages(spark, tables):
    _, _, su, sb = tables
    pri = {r.blog_id: r.prior for r in PR.prior_blog_likelihood(su).collect()}
    assert pri == pytest.approx({1: 4 / 6, 2: 1 / 6, 3: 1 / 6})
    avg = {r.blog_id: r.avg_likes_per_post for r in PR.blog_avg_likes(sb).collect()}
    assert avg[1] == 2.0 and avg[2] is None
    assert PR.mean_blog_likes(sb).first().mean_likes_per_post == pytest.approx(7 / 3)


def test_profile_counts_sum_to_likes(spark, tables):
    posts, likes, _, _ = tables
    p = PR.profile_long(likes, posts)
    lang = {(r.user_id): r.s for r in p.where("kind = 'language'").groupBy("user_id").sum("cnt")
            .withColumnRenamed("sum(cnt)", "s").collect()}
    assert lang == {1: 3, 2: 1}


def test_profile_cap_keeps_largest(spark, tables):
    posts, likes, _, _ = tables
    p = PR.profile_long(likes, posts, cap=1).where("kind = 'tag' AND user_id = 1").collect()
    # u1 tags: x:2, y:2, z:1 -> one entry, ties broken by key
    assert [(r.key, r.cnt) for r in p] == [("x", 2)]


def test_blog_cap_falls_back_to_prior(spark, tables):
    posts, likes, su, sb = tables
    ctx = FE.build_context(posts, likes, su, sb, max_blogs=2)   # u1 has 2 blogs -> left out
    pairs = spark.createDataFrame([(1, 4)], "user_id bigint, post_id bigint")
    r = FE.pair_features(pairs, ctx).first()
    assert r.blog_likelihood == pytest.approx(1 / 6)


def test_pairs_without_profile_are_reported(spark, tables):
    posts, likes, su, sb = tables
    ctx = FE.build_context(posts, likes, su, sb)
    pairs = spark.createDataFrame([(1, 4), (99, 4)], "user_id bigint, post_id bigint")
    assert FE.pair_features(pairs, ctx).count() == 1
    assert [r.user_id for r in FE.users_without_profile(pairs, ctx).collect()] == [99]


def test_hot_user_and_hot_post_are_split(spark):
    """One user holds a third of the pairs, one post many: the salted plan gives the plain plan's rows."""
    posts = spark.createDataFrame([(p, p % 4, p % 3, "en", "a b", "", ["A", f"c{p % 5}"], [f"t{p % 7}"]) for p in range(120)], POSTS_SCHEMA)
    likes = [(0, p) for p in range(60)] + [(u, (7 * u + i) % 120) for u in range(1, 30) for i in range(4)] + [(u, 5) for u in range(1, 30)]
    lk = spark.createDataFrame(sorted(set(likes)), "user_id bigint, post_id bigint")
    su = spark.createDataFrame([(u, b, 1 + u % 3, 4) for u in range(20) for b in range(2)],
                               "user_id bigint, blog_id bigint, likes bigint, num_likes bigint")
    sb = spark.createDataFrame([(b, 5, 2) for b in range(4)], "blog_id bigint, num_likes bigint, num_posts bigint")
    ctx = FE.build_context(posts, lk, su, sb)
    for variant in ("coded", "documented"):
        plain = sorted(map(str, FE.pair_features(lk, ctx, variant).collect()))
        assert plain == sorted(map(str, FE.pair_features(lk, ctx, variant, rows_per_salt=10).collect()))
        assert len(plain) == len(set(likes))


def test_exploded_rows_of_a_task_are_bounded(spark):
    """The more rows there are, the more partitions sort them; odd labels meet only their own kind; the features stay the same."""
    import re
    posts = [(p, None if p % 11 == 0 else p % 4, None if p % 7 == 0 else p % 3, None if p % 5 == 0 else "en", "a b", "",
              ["x", None if p % 3 else "l=en"], ["x", f"t{p % 7}", "", "="]) for p in range(60)]
    posts = spark.createDataFrame(posts, POSTS_SCHEMA)
    lk = spark.createDataFrame([(u, (7 * u + i) % 60) for u in range(40) for i in range(5)], "user_id bigint, post_id bigint")
    su = spark.createDataFrame([(u, b, 1 + u % 3, 4) for u in range(20) for b in range(2)],
                               "user_id bigint, blog_id bigint, likes bigint, num_likes bigint")
    sb = spark.createDataFrame([(b, 5, 2) for b in range(4)], "blog_id bigint, num_likes bigint, num_posts bigint")
    ctx = FE.build_context(posts, lk, su, sb)
    pairs = spark.createDataFrame([(u, (11 * u + i) % 60) for u in range(40) for i in range(9)], "user_id bigint, post_id bigint")
    liked, got = {}, {}
    by_id = {r.post_id: r for r in posts.collect()}
    for r in lk.collect():
        liked.setdefault(r.user_id, []).append(by_id[r.post_id])
    for rows_per_task in (1_000_000, 100):
        f = FE.pair_features(pairs, ctx, "documented", rows_per_task=rows_per_task)
        parts = max(map(int, re.findall(r"hashpartitioning\(user_id#\d+L, salt#\d+, (\d+)\), REPARTITION_BY_NUM", f._jdf.queryExecution().executedPlan().toString())))
        assert parts == FE.task_count(pairs, ctx, rows_per_task) and parts >= 360 * 9 / rows_per_task
        got[rows_per_task] = sorted(map(tuple, f.collect()), key=lambda r: r[:2])
    assert got[100] == got[1_000_000] and len(got[100]) == pairs.distinct().count()
    for u, p, cat, tag, lang, author, *_ in got[100]:
        mine, post = liked[u], by_id[p]
        share = lambda col, own: (sum(1 for q in mine for x in getattr(q, col) if x is not None and x in own)
                                  / sum(len(getattr(q, col)) for q in mine))
        assert cat == pytest.approx(share("categories", post.categories)) and tag == pytest.approx(share("tags", post.tags))
        one = lambda col: 0 if getattr(post, col) is None else sum(getattr(q, col) == getattr(post, col) for q in mine) / len(mine)
        assert lang == pytest.approx(one("language")) and author == pytest.approx(one("author_id"))


def test_sets_of_counts_are_kept_as_bits(spark):
    """Equal counts of a kind collapse at any size of the counts, and no aggregate has a row per pair and count."""
    import dataclasses
    import re
    counts = [1, 1, 2, 62, 63, 63, 64, 65, 65, 127, 128, 1000, 2 ** 40, 2 ** 40, 2 ** 40 + 63]
    tags = [f"t{i}" for i in range(len(counts))]
    posts = [(p, 1, 1, "en", "a b", "", [t for i, t in enumerate(tags) if i % 3 == p % 3], [t for i, t in enumerate(tags) if i >> (p % 4) & 1])
             for p in range(12)]
    posts = spark.createDataFrame([*posts, (12, 1, 1, "en", "a b", "", ["other"], [])], POSTS_SCHEMA)
    pairs = spark.createDataFrame([(u, p) for u in (1, 2) for p in range(13)], "user_id bigint, post_id bigint")
    su = spark.createDataFrame([(1, 1, 3, 3)], "user_id bigint, blog_id bigint, likes bigint, num_likes bigint")
    sb = spark.createDataFrame([(1, 5, 2)], "blog_id bigint, num_likes bigint, num_posts bigint")
    ctx = FE.build_context(posts, pairs, su, sb)
    mine = {u: {t: c + (u - 1) * (i % 2) for i, (t, c) in enumerate(zip(tags, counts))} for u in (1, 2)}
    rows = [(u, kind, t, c) for u in mine for kind in ("category", "tag") for t, c in mine[u].items()]
    profile = spark.createDataFrame(rows, "user_id bigint, kind string, key string, cnt bigint")
    ctx = dataclasses.replace(ctx, profile=profile.unionByName(ctx.profile.where("kind NOT IN ('category', 'tag')")))
    by_id, totals = {r.post_id: r for r in posts.collect()}, {r.user_id: r for r in ctx.user_totals.collect()}
    f = FE.pair_features(pairs, ctx)
    got = f.collect()
    assert len(got) == 26 and len(set(counts)) < len(counts)
    for r in got:
        post, tot = by_id[r.post_id], totals[r.user_id]
        known = mine[r.user_id]
        assert r.categories_likelihood == sum({known[c] for c in post.categories if c in known}) / tot.tot_category
        assert r.tags_likelihood == sum({known[t] for t in post.tags}) / tot.tot_tag
    keys = re.findall(r"HashAggregate\(keys=\[(.*?)\]", f._jdf.queryExecution().executedPlan().toString())
    assert any("_block" in k for k in keys) and not any(re.search(r"\b(cnt|kind)#", k) for k in keys if "post_id" in k)


def test_labels_are_looked_up_and_not_sorted(spark, tables):
    """Nothing sorts or ranks exploded labels; of a label that a profile has twice the larger count holds; labels meet their own kind."""
    posts, likes, su, sb = tables
    twice = su.unionByName(spark.createDataFrame([(1, 1, 9, 4)], su.schema))
    ctx = FE.build_context(posts, likes, twice, sb)
    pairs = spark.createDataFrame([(1, 1), (1, 4), (2, 3), (99, 4), (None, 4)], "user_id bigint, post_id bigint")
    f = FE.pair_features(pairs, ctx)
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan.split("Generate explode(labels")[0]
    got = {(r.user_id, r.post_id): r for r in f.collect()}
    assert set(got) == {(1, 1), (1, 4), (2, 3)}
    assert got[1, 1].blog_likelihood == pytest.approx(9 / 13) and got[1, 4].blog_likelihood == 0
    assert got[2, 3].categories_likelihood == got[2, 3].language_likelihood == 0 and got[2, 3].tags_likelihood == pytest.approx(1 / 2)
    assert got[2, 3].author_likelihood == 1 and got[1, 1].language_likelihood == pytest.approx(2 / 3)


def test_look_ups_read_few_entries_of_a_long_profile(spark):
    """A user of 5,000 tags has many short maps instead of one long one, and the same features."""
    n = 5000
    tags = [f"t{i}" for i in range(n)]
    posts = spark.createDataFrame([(p, 1, 1, "en", "a", "", ["A"], tags[p * 50:p * 50 + 50]) for p in range(n // 50)]
                                  + [(900, 1, 2, "fr", "a", "", ["B"], ["t7", "t4999", "new"])], POSTS_SCHEMA)
    likes = spark.createDataFrame([(1, p) for p in range(n // 50)] + [(2, 3)], "user_id bigint, post_id bigint")
    su = spark.createDataFrame([(1, 1, 3, 3)], "user_id bigint, blog_id bigint, likes bigint, num_likes bigint")
    sb = spark.createDataFrame([(1, 5, 2)], "blog_id bigint, num_likes bigint, num_posts bigint")
    ctx = FE.build_context(posts, likes, su, sb)
    none = FE.hot_keys(likes, ["user_id"])
    maps = {r.user_id: r._tag_counts for r in FE._user_rows(ctx, none, 2).collect()}
    assert {k: v for m in maps[1] for k, v in m.items()} == {f"t={t}": 1 for t in tags}
    assert max(map(len, maps[1])) <= 150 and len(maps[1]) <= 100 and len(maps[2]) <= 8
    pairs = spark.createDataFrame([(1, 900), (2, 900), (1, 3)], "user_id bigint, post_id bigint")
    got = {(r.user_id, r.post_id): r.tags_likelihood for r in FE.pair_features(pairs, ctx, "documented").collect()}
    assert got == {(1, 900): pytest.approx(2 / n), (2, 900): 0, (1, 3): pytest.approx(50 / n)}

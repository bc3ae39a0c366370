"""The seven likelihood features of a (user, post) pair.

Plan per batch of pairs:
  1. pairs join the post attributes on post (a post with very many pairs is
     split into salts, its attributes are copied once per salt);
  2. pairs, each one row with the arrays of its labels, are shuffled once on
     (user, salt), profile rows and user totals together once on the same, into
     as many partitions as the exploded rows ask for (``ROWS_PER_TASK``);
  3. inside those partitions a user's profile becomes one row, maps of counts
     for each kind, and meets the user's pairs.  Language, author and blog are
     one look-up each.  Categories and tags are exploded, looked up, and leave
     before the aggregate per pair if they met nothing; one label of a pair,
     ``USER``, carries all that is finished already.
Exploded rows are neither shuffled nor sorted: the aggregates take the
partitioning of step 2.  A user with very many pairs is split into salts, and
that user's totals and profile rows are copied once per salt.  A task holds
whole profiles, which have one entry per distinct label, however many likes the
user has; a look-up reads about the square root of a kind's entries.

A label is one string: the letter of its kind, ``=`` and the key.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from affinis.functions.expr import FEATURES, safe_div, title_words_of
from affinis.operators import profiles as PR
from affinis.operators.candidates import known_or_counted
from affinis.plans.skew import ROWS_PER_SALT, copied, hot_keys, with_salt

#: Rows (labels of pairs, profile rows) that one task handles, on average.
ROWS_PER_TASK = 1_000_000
#: Rows that are worth a task of their own while there are cores for it.
LEAST_TASK_ROWS = 200_000
#: Kinds that pairs are matched on, by the letter of their labels.
LETTERS = {"category": "c", "tag": "t", "language": "l", "author": "a", "blog": "b"}
#: Kinds with several labels a post; the others have one.
SETS = {"cat": "category", "tag": "tag"}
SINGLE = {"language": "language", "author": "author_id", "blog": "blog_id"}
#: The label of a pair's own row, which no profile has.
USER = "u"


@dataclass
class FeatureContext:
    post_attrs: DataFrame      # post_id, blog_id, title_len, labels, language, author, blog, blog_likes, avg_likes_per_post
    profile: DataFrame         # user_id, kind, key, cnt (truncated maps + blog rows from the statistics)
    user_totals: DataFrame     # user_id, tot_*, tl_*, has_blog_map, blog_total
    prior_total: Column        # scalar: sum of blog likes over all blogs


def build_context(posts: DataFrame, train_likes: DataFrame, stats_user: DataFrame, stats_blog: DataFrame,
                  top_entries: int | None = None, max_blogs: int | None = None, stage=None) -> FeatureContext:
    """Profiles, totals and post attributes for ``pair_features``.

    ``top_entries`` (T1) and ``max_blogs`` (P9) cut the profiles as the
    reference's workflow does; by default nothing is cut.
    ``stage(name, build, *params)``, when given, writes the tables that feed
    several joins before anything is derived from them.
    """
    stage = stage or (lambda name, build, *params: build())
    profile = stage("profile", lambda: PR.profile_long(train_likes, posts, cap=top_entries), top_entries)

    own = PR.capped_stats_users(stats_user, max_blogs)
    blog_rows = own.select("user_id", F.lit("blog").alias("kind"), F.col("blog_id").cast("string").alias("key"),
                           F.col("likes").alias("cnt"))
    blog_tot = own.groupBy("user_id").agg(F.sum("likes").alias("blog_total"))
    totals = stage("user_totals", lambda: (
        PR.user_profile_totals(profile).join(blog_tot, "user_id", "left")
        .withColumn("has_blog_map", F.col("blog_total").isNotNull())), top_entries, max_blogs)

    blog_likes = PR.blog_like_totals(stats_user)
    prior_total = blog_likes.agg(F.sum("blog_likes")).scalar()
    mean_likes = stats_blog.agg(safe_div(F.sum("num_likes"), F.sum("num_posts"))).scalar()
    blog_avg = stats_blog.select("blog_id", safe_div("num_likes", "num_posts").alias("_avg"), F.lit(True).alias("_known"))
    attrs = stage("post_attrs", lambda: (
        posts.select("post_id", "blog_id", title_words_of(posts).alias("title_len"), post_labels().alias("labels"),
                     *[label_of(kind, F.col(c)).alias(kind) for kind, c in SINGLE.items()])
        .join(blog_likes, "blog_id", "left")
        .join(blog_avg, "blog_id", "left")
        .withColumn("avg_likes_per_post", F.when(F.col("_known"), F.col("_avg")).otherwise(mean_likes))
        .drop("_avg", "_known")))
    return FeatureContext(attrs, profile.unionByName(blog_rows), totals, prior_total)


def label_of(kind: str, key: Column) -> Column:
    """A post's label; a missing key gives the bare letter, which no profile has."""
    return F.concat(F.lit(LETTERS[kind]), F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("")))


def post_labels() -> Column:
    """Per post, its labels of the kinds with several (categories, tags), and ``USER`` for the pair itself.

    Built once per post, so a pair only explodes a ready array.
    """
    return F.concat(
        F.transform("categories", lambda c: label_of("category", c)),
        F.transform("tags", lambda t: label_of("tag", t)),
        F.array(F.lit(USER)),
    )


def profile_labels(profile: DataFrame) -> DataFrame:
    """(user_id, label, known): the profile rows that a label can meet."""
    letter = F.coalesce(*[F.when(F.col("kind") == k, F.lit(v)) for k, v in LETTERS.items()])
    return profile.select("user_id", F.concat(letter, F.lit("="), "key").alias("label"), F.col("cnt").alias("known")).where(
        F.col("label").isNotNull())


def bit_of(count: Column) -> Column:
    """The bit of a count among the 64 counts of its row (``count`` shifted right by 6)."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), count.bitwiseAND(F.lit(63)).cast("int"))


def sum_of_bits(bits: Column, row: Column) -> Column:
    """The sum of the counts that ``bits`` holds for the 64 counts from 64 * ``row`` on."""
    total = F.lit(64) * row * F.bit_count(bits)
    for j in range(6):
        mask = sum(1 << i for i in range(63) if i >> j & 1) - (1 << 63)       # places with bit j, the last one (63) has all
        total = total + F.lit(1 << j) * F.bit_count(bits.bitwiseAND(F.lit(mask).cast("bigint")))
    return total


def task_count(pairs: DataFrame, ctx: FeatureContext, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Partitions for the labels of ``pairs`` with their profiles: no more rows a task than ``rows_per_task``, on average."""
    one = F.count(F.lit(1))
    n, per, known = pairs.sparkSession.range(1).select(
        pairs.agg(one).scalar(), ctx.post_attrs.agg(F.avg(F.size("labels"))).scalar(), profile_labels(ctx.profile).agg(one).scalar()).first()
    rows = n * ((per or 0.0) + len(SINGLE)) + known
    spread = min(pairs.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / LEAST_TASK_ROWS))
    return max(2, spread, math.ceil(rows / rows_per_task))


def pair_features(pairs: DataFrame, ctx: FeatureContext, variant: str = "coded",
                  keep: list[str] | None = None, rows_per_salt: int = ROWS_PER_SALT,
                  dropped: Observation | None = None, strict: bool = False, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(user_id, post_id, *FEATURES[, keep...]) for every pair whose user has a profile.

    ``dropped`` counts the pairs left out (``n_dropped``) in the same job; ``strict`` fails on the first one.

    ``variant="coded"`` reproduces the reference's arithmetic (equal counts of
    a set collapse; title-length average is likes per distinct length);
    ``variant="documented"`` computes what its README describes.
    """
    keep = keep or []
    pair = ["user_id", "post_id", *keep]
    hot, hot_posts = hot_keys(pairs, ["user_id"], rows_per_salt), hot_keys(pairs, ["post_id"], rows_per_salt)
    own = ["title_len", "blog_likes", "avg_likes_per_post", *SINGLE]
    attrs = copied(ctx.post_attrs.select("post_id", "labels", *own), hot_posts, "post_id", "part")
    p = with_salt(pairs.select(*pair), hot_posts, "post_id", "user_id", "part").join(attrs, ["post_id", "part"]).drop("part")
    tasks = task_count(pairs, ctx, rows_per_task)
    rows = with_salt(p, hot, "user_id", "post_id").repartition(tasks, "user_id", "salt")
    rows = rows.join(_user_rows(ctx, hot, tasks), ["user_id", "salt"], "left")

    coded = variant == "coded"
    z = F.lit(0)
    tl_avg = safe_div("tl_sum", "tl_n") if coded else safe_div("tl_wsum", "tl_sum")
    met = {kind: F.coalesce(_count(kind, F.col(kind)), z) for kind in SINGLE}
    blog = F.when(F.col("has_blog_map"), safe_div(met["blog"], "blog_total")).otherwise(
        safe_div(F.coalesce("blog_likes", z), ctx.prior_total))
    finished = {
        FEATURES[2]: safe_div(met["language"], "tot_language"),
        FEATURES[3]: safe_div(met["author"], "tot_author"),
        FEATURES[4]: F.abs(tl_avg - F.col("title_len")),
        FEATURES[5]: blog,
        FEATURES[6]: F.col("avg_likes_per_post"),
    }
    carried = ["_known", "tot_category", "tot_tag", *finished]
    rows = rows.select(*pair, "salt", "labels", "_known", "tot_category", "tot_tag", *[c.alias(k) for k, c in finished.items()],
                       *[_entries(kind) for kind in SETS.values()])
    rows = rows.withColumn("_label", F.explode("labels"))
    mine = F.col("_label") == USER
    kind = F.substring("_label", 1, 1)
    cnt = F.coalesce(*[F.when(kind == LETTERS[k], _count(k, F.col("_label"))) for k in SETS.values()])
    matched = rows.select(*pair, "salt", kind.alias("kind"), cnt.alias("cnt"), *[F.when(mine, F.col(c)).alias(c) for c in carried]).where(
        F.col("cnt").isNotNull() | (F.col("kind") == USER))

    def of(kind, value=F.col("cnt")):
        return F.when(F.col("kind") == LETTERS[kind], value)

    # equal in all rows of a pair that hold them
    single = [F.max(c).alias(c) for c in carried]
    if coded:
        # equal counts of one kind collapse (a set of counts)
        block = F.coalesce(F.shiftright("cnt", 6), F.lit(0))
        f = matched.withColumn("_block", block).groupBy(*pair, "salt", "_block").agg(
            *single, *[F.bit_or(of(kind, bit_of(F.col("cnt")))).alias(c) for c, kind in SETS.items()])
        f = f.groupBy(*pair, "salt").agg(*single, *[F.sum(sum_of_bits(F.col(c), F.col("_block"))).alias(c) for c in SETS])
    else:
        f = matched.groupBy(*pair, "salt").agg(*single, *[F.sum(of(kind)).alias(c) for c, kind in SETS.items()])
    f = known_or_counted(f, "_known", "user_id", dropped, strict)
    return f.select(
        "user_id", "post_id", *keep,
        safe_div(F.coalesce("cat", z), "tot_category").alias(FEATURES[0]),
        safe_div(F.coalesce("tag", z), "tot_tag").alias(FEATURES[1]),
        *FEATURES[2:],
    )


def _entries(kind: str) -> str:
    return f"_{kind}_counts"


def _maps(entries: Column, n: Column) -> Column:
    """(label, known) entries as ``n`` maps, by a hash of the label."""
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.map_from_entries(
        F.filter(entries, lambda e: F.pmod(F.xxhash64(e["label"]), n) == i)))


def _count(kind: str, label: Column) -> Column:
    """The user's count of a label of this kind; null without one."""
    maps = F.col(_entries(kind))
    return F.try_element_at(F.get(maps, F.pmod(F.xxhash64(label), F.size(maps)).cast("int")), label)


def _user_rows(ctx: FeatureContext, hot: DataFrame, tasks: int) -> DataFrame:
    """One row per (user, salt): the totals, and the counts of each kind as maps from label to count.

    Spark reads a map from its start, so a kind's n labels are spread over about sqrt(n) maps of as many entries.
    """
    of_user = [c for c in ctx.user_totals.columns if c != "user_id"]
    totals = ctx.user_totals.withColumns({"label": F.lit(USER), "_known": F.lit(True)})
    known = profile_labels(ctx.profile).unionByName(totals, allowMissingColumns=True)
    # in the partitions of the pairs; a label's count is there once, also where a profile has it twice
    known = copied(known, hot, "user_id").repartition(tasks, "user_id", "salt")
    known = known.groupBy("user_id", "salt", "label").agg(*[F.max(c).alias(c) for c in ("known", "_known", *of_user)])
    entry = {kind: F.when(F.col("label").startswith(f"{x}="), F.struct("label", "known")) for kind, x in LETTERS.items()}
    rows = known.groupBy("user_id", "salt").agg(
        *[F.max(c).alias(c) for c in ("_known", *of_user)], *[F.collect_list(e).alias(kind) for kind, e in entry.items()])
    rows = rows.withColumns({f"_{kind}_maps": F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(kind)))).cast("int") for kind in LETTERS})
    return rows.select("user_id", "salt", "_known", *of_user,
                       *[_maps(F.col(kind), F.col(f"_{kind}_maps")).alias(_entries(kind)) for kind in LETTERS])


def users_without_profile(pairs: DataFrame, ctx: FeatureContext) -> DataFrame:
    """J1 check: pairs whose user has no profile (the reference fails on them)."""
    return pairs.join(ctx.user_totals.select("user_id"), "user_id", "left_anti")

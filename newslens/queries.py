"""Every operator as a query over the test tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens import constants as C
from newslens import fixtures as X
from newslens.functions.arrays import parse_int_list, print_int_list, spread_array
from newslens.functions.text import clean_text
from newslens.operators import accounts as A
from newslens.operators import histograms as H
from newslens.operators.accounts import tagged_ids
from newslens.operators.context import score_in_context
from newslens.operators.dedupe import dedupe_posts, dedupe_users
from newslens.operators.labels import label_features
from newslens.operators.near_hash import fit_hashed
from newslens.operators.nearest import fit_nearest
from newslens.operators.sampling import cap_rows, hash_split, stratified_split
from newslens.operators.sentiment import score_sentiment, with_sentiment_bins
from newslens.operators.votes import majority_vote, model_accuracy, verdict, verdict_of_row
from newslens.plans.features import assemble, link_features, scored_posts
from newslens.plans.scoring import score_links
from newslens.plans.training import (
    ModelSet,
    accuracy_table,
    fit_models,
    predict_all,
    predict_wide,
)
from newslens.session import fresh_path, written
from newslens.sources.lookups import (
    flatten_status,
    lookup_statuses,
    posts_for_links,
    statuses_with_user,
)
from newslens.sources.readers import (
    read_feature_store,
    read_features,
    read_labels,
    read_lines,
    read_posts,
    read_users,
)
from newslens.sources.tables import prepare_posts, prepare_users, with_account_age
from newslens.sources.writers import write_feature_store, write_features, write_posts, write_users

Query = Callable[[SparkSession, str], DataFrame]


def _text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.documents(spark, sf_dir).select("doc_id", clean_text("text").alias("clean"))


def _posts_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column as text, as a CSV scan gives it; retweets with decimals."""
    raw = X.raw_posts(spark, sf_dir, decimals=True)
    return prepare_posts(raw.select([F.col(c).cast("string") for c in raw.columns]))


def _users_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = X.users(spark, sf_dir)
    return prepare_users(raw.select([F.col(c).cast("string") for c in raw.columns]))


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedupe_posts(X.posts(spark, sf_dir))
    return score_sentiment(kept, X.lexicon(spark), ["link", "tweet_id"])


def _context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every kept post with phrases, negation and intensity."""
    kept = dedupe_posts(X.posts(spark, sf_dir))
    return score_in_context(kept, X.phrases(spark), ["link", "tweet_id"])


def _bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_sentiment_bins(_scores(spark, sf_dir)).drop("polarity", "subjectivity")


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_posts(X.posts(spark, sf_dir), X.lexicon(spark))


def _text_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = H.text_histogram(_scored(spark, sf_dir))
    return histogram.select("link", *spread_array("textFeatures", C.TEXT_WIDTH, "text"))


def _retweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.retweet_total(dedupe_posts(X.posts(spark, sf_dir)))


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.join_posts_users(X.posts(spark, sf_dir), X.repeated_users(spark, sf_dir))


def _user_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.with_ratios(_joined(spark, sf_dir)).select(
        "link", "tweet_id", "verified", "follower_ratio", "activity"
    )


def _user_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.with_user_bins(_joined(spark, sf_dir)).select(
        "link", "tweet_id", F.col("verified").cast("int").alias("verified"),
        "ratio_bin", "activity_bin",
    )


def _user_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.user_groups(A.with_user_bins(_joined(spark, sf_dir)))


def _user_histogram(activity: str, verified: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        binned = A.with_user_bins(_joined(spark, sf_dir), activity)
        histogram = H.user_histogram(binned, verified)
        return histogram.select("link", *spread_array("userFeatures", C.USER_WIDTH, "user"))

    return query


def _verified_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.verified_share(_joined(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_features(
        X.posts(spark, sf_dir), X.repeated_users(spark, sf_dir), X.lexicon(spark)
    )


_PARTS = [
    *[f"text_{i}" for i in range(C.TEXT_WIDTH)],
    *[f"user_{i}" for i in range(C.USER_WIDTH)],
    "retweets",
]


def _flat_vectors(rows: DataFrame) -> DataFrame:
    return assemble(rows).select(
        "link", *[F.col("features")[i].alias(name) for i, name in enumerate(_PARTS)]
    )


def _feature_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_vectors(features(spark, sf_dir))


def _feature_vector_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for more users than a broadcast holds: both sides shuffle, hot posts are cut."""
    wide = link_features(
        X.posts(spark, sf_dir), X.repeated_users(spark, sf_dir), X.lexicon(spark),
        piece_rows=3, spread=True,
    )
    return _flat_vectors(wide)


def _feature_vector_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_vectors(
        link_features(
            X.posts(spark, sf_dir), X.repeated_users(spark, sf_dir), X.phrases(spark), scorer=score_in_context
        )
    )


def _merge_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_link = H.text_histogram(_scored(spark, sf_dir)).withColumn(
        "host", F.split_part("link", F.lit("/"), F.lit(3))
    )
    merged = H.merge_feature_arrays(by_link, "host", "textFeatures", C.TEXT_WIDTH)
    return merged.select("host", *spread_array("textFeatures", C.TEXT_WIDTH, "text"))


def _posts_for_links(late: bool | None = None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        wanted = X.labels(spark, sf_dir).where("credibility = 'fake'")
        return posts_for_links(X.posts(spark, sf_dir), wanted.select(F.col("news_url").alias("link")), late)

    return query


def _lookup_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = X.posts(spark, sf_dir).select(F.col("tweet_id").cast("bigint"))
    return lookup_statuses(X.statuses(spark, sf_dir), ids)


def _account_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots = statuses_with_user(X.statuses(spark, sf_dir))
    as_of = F.lit(f"{X.AS_OF} 00:00:00+00:00").cast("timestamp")
    return with_account_age(snapshots, as_of).select("tweetid", "account_age")


def _parse_int_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    printed = H.text_histogram(_scored(spark, sf_dir)).select(
        "link", print_int_list("textFeatures").alias("printed")
    )
    parsed = printed.select("link", parse_int_list("printed").alias("parsed"))
    return parsed.select("link", *spread_array("parsed", C.TEXT_WIDTH, "text"))


def _csv_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "posts-csv")
    write_posts(X.raw_posts(spark, sf_dir), path)
    return read_posts(spark, f"{path}/*.csv").withColumn(
        "date", F.date_format("date", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


def _csv_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "users-csv")
    write_users(statuses_with_user(X.statuses(spark, sf_dir)), path)
    return read_users(spark, f"{path}/*.csv")


def _csv_prepared_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "prepared-users-csv")
    as_of = F.lit(f"{X.AS_OF} 00:00:00+00:00").cast("timestamp")
    write_users(with_account_age(statuses_with_user(X.statuses(spark, sf_dir)), as_of), path)
    return read_users(spark, f"{path}/*.csv")


def _csv_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "features-csv")
    write_features(features(spark, sf_dir), path)
    return _flat_vectors(read_features(spark, f"{path}/*.csv"))


def _labels_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "labels-csv")
    wide = X.labels(spark, sf_dir).select(
        F.lit("not read").alias("title"), "credibility", "news_url"
    )
    wide.write.option("header", True).csv(path)
    return read_labels(spark, f"{path}/*.csv", keep_missing=True)


def _text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "lines")
    X.table(spark, sf_dir, "documents").select("text").write.text(path)
    return read_lines(spark, path, min_partitions=16).agg(
        F.count("*").alias("lines"), F.sum(F.length("value")).alias("chars")
    )


def _union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = tagged_ids(X.posts(spark, sf_dir), X.repeated_users(spark, sf_dir))
    return tagged.groupBy("source", "tweet_id").agg(F.count("*").alias("n"))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_features(assemble(features(spark, sf_dir)), X.labels(spark, sf_dir))


def _feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled vectors by way of the bucketed table: vectors are not moved for the join."""
    path = fresh_path(spark, "features")
    table = "features_" + path.rsplit("-", 1)[-1]
    write_feature_store(features(spark, sf_dir), table, 16, path)
    labelled = label_features(assemble(read_feature_store(spark, table)), X.labels(spark, sf_dir))
    return labelled.select(
        "link", "label", *[F.col("features")[i].alias(name) for i, name in enumerate(_PARTS)]
    )


def _labeled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).select(
        "link", "label", *[F.col("features")[i].alias(name) for i, name in enumerate(_PARTS)]
    )


def _training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled vectors with their side of the split."""
    return stratified_split(written(_labelled(spark, sf_dir), "labelled"))


def _training_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_rows(written(_labelled(spark, sf_dir), "labelled"), 100).select("link", "label")


def _split_and_fit(rows: DataFrame, voters: tuple[str, ...]) -> tuple[ModelSet, DataFrame]:
    """Models of the training side, and the test side."""
    rows = written(rows, "split")
    models = fit_models(rows.where(~F.col("is_test")), voters)
    return models, rows.where("is_test").drop("is_test")


def _margin_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_split(X.margin_rows(spark, sf_dir))


def _plane_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_split(X.plane_rows(spark, sf_dir))


def _overlap_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_split(X.overlap_rows(spark, sf_dir))


def _predictions(*voters: str, of: Query = _training_set) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        models, test = _split_and_fit(of(spark, sf_dir), voters)
        found = predict_all(models, test)
        return found if len(voters) > 1 else found.drop("model")

    return query


def _hold_out_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model's accuracy on the held-out rows."""
    models, test = _split_and_fit(_training_set(spark, sf_dir), ("naiveBayes",))
    return model_accuracy(predict_all(models, test))


def _accuracy_table(of: Query) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return accuracy_table(*_split_and_fit(of(spark, sf_dir), C.VOTERS))

    return query


def _margin_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven voters on every row, their votes and the verdict."""
    models, _ = _split_and_fit(_margin_set(spark, sf_dir), C.VOTERS)
    wide = predict_wide(models, X.margin_rows(spark, sf_dir))
    return _flat_verdict(verdict_of_row(wide, {}))


def _score_links(*voters: str, stored: bool = False) -> Query:
    """Verdicts on all links, trained on the labelled ones; or on given links, from stored models."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Read twice, for the labelled links and for all; given links have vectors of their own posts.
        vectors = written(assemble(features(spark, sf_dir)), "vectors")
        labelled = label_features(vectors, X.labels(spark, sf_dir))
        models, _ = _split_and_fit(stratified_split(written(labelled, "labelled")), voters)
        links = None
        if stored:
            path = fresh_path(spark, "models")
            models.save(path)
            models = ModelSet.load(spark, path)
            wanted = X.labels(spark, sf_dir).where("credibility = 'fake'")
            links = wanted.select(F.col("news_url").alias("link"))
        scored = score_links(
            X.posts(spark, sf_dir), X.repeated_users(spark, sf_dir), X.lexicon(spark), models, links, vectors
        )
        return _flat_verdict(scored, voters)

    return query


def _flat_verdict(verdicts: DataFrame, voters: tuple[str, ...] = C.VOTERS) -> DataFrame:
    reported = [m for m in voters if m not in C.UNREPORTED]
    return verdicts.select(
        "link", "credibility", "fake_votes", "real_votes",
        *[F.element_at("model_result", m).alias(m) for m in reported],
    )


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_split(
        X.table(spark, sf_dir, "embeddings").select(
            "vec_id",
            F.col("embedding").cast("array<double>").alias("features"),
            F.col("label").cast("string").alias("label"),
        ),
        key="vec_id",
    )


def _knn_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label of a near neighbour among all training rows, and the true one."""
    rows = _embeddings(spark, sf_dir)
    index = fit_hashed(rows.where(~F.col("is_test")), key="vec_id")
    test = rows.where("is_test")
    return test.select("vec_id", "label").join(index.predict(test, "vec_id"), "vec_id")


def _knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _embeddings(spark, sf_dir)
    model = fit_nearest(rows.where(~F.col("is_test")), key="vec_id")
    return model.predict(rows.where("is_test")).select(
        "vec_id", "label", "prediction"
    )


def _model_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_accuracy(_knn(spark, sf_dir).withColumn("model", F.lit("knn")))


def queries() -> dict[str, Query]:
    return {
        "clean_text": _text,
        "posts_prepared": _posts_prepared,
        "users_prepared": _users_prepared,
        "dedupe_posts": lambda s, d: dedupe_posts(X.posts(s, d)),
        "dedupe_users": lambda s, d: dedupe_users(X.repeated_users(s, d)),
        "sentiment_scores": _scores,
        "sentiment_context": _context,
        "sentiment_bins": _bins,
        "sentiment_groups": lambda s, d: H.sentiment_groups(_scored(s, d)),
        "text_histogram": _text_histogram,
        "retweet_total": _retweets,
        "join_posts_users": _joined,
        "user_ratios": _user_ratios,
        "user_bins": _user_bins,
        "user_groups": _user_groups,
        "user_histogram_compat": _user_histogram("compat", "groups"),
        "user_histogram_by_age": _user_histogram("age", "count"),
        "verified_share": _verified_share,
        "feature_vector": _feature_vector,
        "feature_vector_spread": _feature_vector_spread,
        "feature_vector_context": _feature_vector_context,
        "merge_arrays": _merge_arrays,
        "posts_for_links": _posts_for_links(),
        "posts_for_links_late": _posts_for_links(late=True),
        "lookup_users": _lookup_users,
        "flatten_status": lambda s, d: flatten_status(X.statuses(s, d)),
        "account_age": _account_age,
        "parse_int_list": _parse_int_list,
        "csv_posts_roundtrip": _csv_posts,
        "csv_users_roundtrip": _csv_users,
        "csv_prepared_users_roundtrip": _csv_prepared_users,
        "csv_features_roundtrip": _csv_features,
        "feature_store": _feature_store,
        "labels_scan": _labels_scan,
        "text_scan": _text_scan,
        "union_sources": _union_sources,
        "labeled_features": _labeled_features,
        "stratified_split": lambda s, d: _training_set(s, d).drop("features"),
        "hash_split": lambda s, d: hash_split(_labelled(s, d)).drop("features"),
        "training_cap": _training_cap,
        "knn_1": _knn,
        "knn_hashed": _knn_hashed,
        "model_accuracy": _model_accuracy,
        "majority_vote": lambda s, d: majority_vote(X.predictions(s, d)),
        "verdict": lambda s, d: _flat_verdict(verdict(X.predictions(s, d))),
        "predict_gaussian_nb": _predictions("naiveBayes"),
        "hold_out_accuracy": _hold_out_accuracy,
        "predict_knn": _predictions("knn"),
        "predict_tree": _predictions("decisionTree"),
        "predict_forest": _predictions("randomForest"),
        "predict_logistic": _predictions("lr"),
        "predict_linear_svc": _predictions("sgd"),
        "predict_gbt": _predictions("xgb"),
        "all_predictions": _predictions(*C.VOTERS),
        "accuracy_table": _accuracy_table(_training_set),
        "margin_tree": _predictions("decisionTree", of=_margin_set),
        "margin_forest": _predictions("randomForest", of=_margin_set),
        "margin_logistic": _predictions("lr", of=_margin_set),
        "margin_linear_svc": _predictions("sgd", of=_margin_set),
        "margin_gbt": _predictions("xgb", of=_margin_set),
        "margin_all_predictions": _predictions(*C.VOTERS, of=_margin_set),
        "margin_accuracy_table": _accuracy_table(_margin_set),
        "margin_verdicts": _margin_verdicts,
        "overlap_tree": _predictions("decisionTree", of=_overlap_set),
        "overlap_forest": _predictions("randomForest", of=_overlap_set),
        "overlap_gbt": _predictions("xgb", of=_overlap_set),
        "plane_linear_sgd": _predictions("sgd", of=_plane_set),
        "score_links_knn_nb": _score_links("knn", "naiveBayes"),
        "score_links_for": _score_links("knn", "naiveBayes", stored=True),
        "score_links": _score_links(*C.VOTERS),
    }

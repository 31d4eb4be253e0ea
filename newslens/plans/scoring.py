"""Verdicts for any number of links in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from newslens.operators.votes import verdict_of_row
from newslens.plans.features import assemble, link_features
from newslens.plans.training import ModelSet, predict_wide
from newslens.sources.lookups import posts_for_links


def score_links(
    posts: DataFrame,
    users: DataFrame,
    lexicon: DataFrame,
    models: ModelSet,
    links: DataFrame | None = None,
    vectors: DataFrame | None = None,
) -> DataFrame:
    """(link, credibility, fake_votes, real_votes, model_result, accuracy).

    All links of `posts`, or only those in `links`; a link without a known author has no row.
    `vectors` (link, features) are those of all links of `posts`, where they are at hand: texts, which cost
    most, are not scored again.
    """
    if vectors is None or links is not None:
        wanted = posts if links is None else posts_for_links(posts, links)
        vectors = assemble(link_features(wanted, users, lexicon))
    return verdict_of_row(predict_wide(models, vectors), models.accuracy)

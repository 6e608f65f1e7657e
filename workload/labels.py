"""Label, feature, metric and model queries."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from shelfwise.constants import GLOBAL_LEVELS
from shelfwise.operators import features as X
from shelfwise.operators import labels as L
from shelfwise.operators import metrics as M
from shelfwise.operators import model as N
from shelfwise.operators.materialise import fresh_path, settle
from shelfwise.plans.suspects import SuspectSettings, inference_metrics, predict, run_suspects, write_suspects
from shelfwise.sources.tables import read_csv, tag_split
from workload.base import branded, branded_sql, table

# Rows marked as errors get a corrected first level; the other levels stay.
LEVELS = list(GLOBAL_LEVELS)
FIXED = ("select *, case when is_error = 1 then 'NO FOOD' end as correct_hierarchy_level1_desc, "
         + ", ".join(f"case when is_error = 1 then {c} end as correct_{c}" for c in LEVELS[1:]) + " from {rows}")


def _items(spark, sf):
    return branded(spark, sf, with_id=True)


def _label_map(spark, sf):
    return L.build_label_map(_items(spark, sf), "row_id")


def _encoded(spark, sf):
    rows = _items(spark, sf)
    # Encoded with a map learned on the food half, so that unseen labels occur.
    learned = L.build_label_map(rows.filter(F.col("hierarchy_level1_desc") == "FOOD"), "row_id")
    return L.encode_labels(rows, learned).select("row_id", *[f"{c}_idx" for c in GLOBAL_LEVELS])


def _fixed(spark, sf):
    rows = spark.sql(FIXED, rows=_items(spark, sf))
    learned = settle(L.build_label_map(rows, "row_id", LEVELS), "labels").frame
    return L.encode_labels(L.encode_labels(rows, learned, LEVELS), learned, LEVELS, prefix="correct_")


def _targets(spark, sf):
    wrong = F.col("is_error") == 1
    return _fixed(spark, sf).select("row_id", *[L.level_target(c, wrong).alias(f"target_{c}") for c in LEVELS])


def _decoded(spark, sf):
    rows = _items(spark, sf)
    learned = settle(L.build_label_map(rows, "row_id", LEVELS), "labels").frame
    coded = L.encode_labels(rows, learned, LEVELS)
    # A stand-in prediction: the number of the neighbouring label, 0 being "unknown".
    predicted = coded.select("row_id", *[(F.col(f"{c}_idx") - 1).alias(f"pred_{c}_idx") for c in LEVELS])
    return L.decode_labels(predicted, learned, LEVELS)


def _scored_documents(spark, sf):
    joined = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"),
                                             "doc_id")
    return joined.select("doc_id", "lang", F.col("quality").alias("is_error"), F.col("toxic").alias("pred_is_error"),
                         (F.col("n_chars") % 997 / 1000).alias("pred_probs"))


def _level_accuracy(spark, sf):
    rows = _items(spark, sf)
    return M.level_accuracy(rows, [
        ("level5 vs level4", "global_hierarchy_level5_desc", "global_hierarchy_level4_desc"),
        ("colour vs colour", "color_desc", "color_desc"),
        ("brand vs brand", "local_brand_name", "global_brand_name"),
    ], "is_error")


def _split_rows(spark, sf):
    docs = table(spark, sf, "documents")
    train, test = tag_split(docs.filter(F.col("doc_id") % 5 != 0), docs.filter(F.col("doc_id") % 5 == 0))
    return train.unionByName(test)


def _suspect_types(spark, sf):
    return M.for_sink(_scored_documents(spark, sf), ["doc_id", "lang"], ["is_error", "pred_is_error"]).drop(
        "pred_probs")


def _embedding_scores(kind):
    """Trained on three quarters of the rows; a row is wrong where the first component is positive. Nine of ten rows
    held out have to be found, which no constant answer does."""
    def run(spark, sf):
        rows = settle(table(spark, sf, "embeddings").select(
            "vec_id", (F.col("embedding")[0] > 0).cast("int").alias("is_error"),
            array_to_vector("embedding").alias("features")), "vectors").frame
        model = N.train_error_model(rows.filter("vec_id % 4 <> 1"), kind=kind)
        scored = settle(N.score_errors(rows.filter("vec_id % 4 = 1"), model).drop("features"), "scored").frame
        right = scored.agg(F.avg((F.col("pred_is_error") == F.col("is_error")).cast("int"))).first()[0]
        return scored.select("vec_id", "is_error", *_sound(), F.lit(right >= 0.9).alias("accurate"))

    return run


def _sound():
    """What holds for any trained model: the prediction follows the probability, which lies between 0 and 1."""
    p = F.col("pred_probs")
    return [((F.col("pred_is_error") == 1) == (p > 0.5)).alias("follows"), p.between(0, 1).alias("in_range")]


# Every seventh row is filed wrongly: its first level is turned over and its third is a shelf of its own. The true
# labels are the corrected ones. Every fifth row is held out from training.
PLANTED = f"""select * except (is_error, hierarchy_level1_desc, global_hierarchy_level3_desc),
  cast(row_id % 7 = 3 as int) as is_error, row_id % 5 = 1 as held_out,
  case when row_id % 7 <> 3 then hierarchy_level1_desc when hierarchy_level1_desc = 'FOOD' then 'NO FOOD'
    else 'FOOD' end as hierarchy_level1_desc,
  case when row_id % 7 = 3 then 'UNSORTED' else global_hierarchy_level3_desc end as global_hierarchy_level3_desc,
  {", ".join(f"case when row_id % 7 = 3 then {c} end as correct_{c}" for c in LEVELS)} from {{rows}}"""
# A corrector is right so many times as often as the best constant answer, on the levels whose labels repeat.
OVER_CONSTANT = 1.2
REPEATING = LEVELS[:4]


def _trained(spark, sf, settings):
    """The planted rows, the model folder, and the predictions for the rows held out."""
    rows = settle(spark.sql(PLANTED, rows=_items(spark, sf)), "items").frame
    folder = fresh_path(spark, "model")
    run_suspects(spark, rows.filter("not held_out"), None, "train", folder, settings)
    return rows, folder, run_suspects(spark, None, rows.filter("held_out"), "inference", folder, settings)


def _suspect_items(spark, sf):
    """All six levels, default width and epochs. Suspects are the contradicted rows, or the ten highest scores; of the
    planted errors held out some are found, and nine of ten right rows are left alone."""
    settings = SuspectSettings()
    rows, folder, found = _trained(spark, sf, settings)
    found = settle(found, "found").frame
    known = found.join(rows.filter("held_out").select("row_id"), "row_id", "left_semi").count() == found.count()
    contradicted = found.filter("is_error <> pred_is_error").count()
    scored = predict(spark, rows.filter("held_out"), folder, settings)
    recall, kept = scored.agg(F.avg(F.when(F.col("is_error") == 1, F.col("pred_is_error"))),
                              F.avg(F.when(F.col("is_error") == 0, 1 - F.col("pred_is_error")))).first()
    return found.groupBy().agg(
        F.lit(known).alias("known_ids"), F.lit(contradicted in (0, found.count())).alias("all_or_none"),
        (F.lit(contradicted > 0) | (F.count(F.lit(1)) == 10)).alias("listed"),
        F.lit(recall >= 0.2).alias("errors_found"), F.lit(kept >= 0.9).alias("right_kept"),
        *[F.every(c).alias(n) for c, n in zip(_sound(), ("follows", "in_range"))])


def _corrected_items(spark, sf):
    """All six levels, default width and epochs; predicted labels are a path of labels that occurs, and on the rows
    held out each of the first levels is right more often than the best constant answer."""
    rows, folder, found = _trained(spark, sf, SuspectSettings(correct_levels=True))
    found = settle(found, "found").frame
    truth = [F.coalesce(f"correct_{c}", c).alias(f"true_{c}") for c in LEVELS]
    labels = spark.read.parquet(f"{folder}/label_map")
    numbers = [f"{c}_idx" for c in LEVELS]

    def coded(df, prefix):
        return L.encode_labels(df.select("row_id", *[F.col(f"{prefix}{c}").alias(c) for c in LEVELS]), labels, LEVELS)

    real = coded(rows.filter("not held_out").select("row_id", *truth), "true_").select(*numbers).distinct()
    strange = coded(found, "pred_").join(real, numbers, "left_anti").select("row_id").withColumn("odd", F.lit(True))
    ready = found.select("*", *truth)
    rates = {}
    for c in REPEATING:
        most = ready.groupBy(f"true_{c}").count().agg((F.max("count") / F.sum("count"))).first()[0]
        right = ready.agg(F.avg((F.col(f"pred_{c}") == F.col(f"true_{c}")).cast("int"))).first()[0]
        rates[c] = right >= OVER_CONSTANT * most
    return ready.join(strange, "row_id", "left").select(
        "row_id", "is_error", *_sound(), F.col("odd").isNull().alias("real_path"),
        *[F.lit(rates[c]).alias(f"better_{c}") for c in REPEATING])


def _inference_metrics(spark, sf):
    scored = _scored_documents(spark, sf).withColumn("level", F.col("lang")).withColumn("pred_level", F.when(
        F.col("doc_id") % 3 != 0, F.col("lang")))
    return _rounded(inference_metrics(scored, SuspectSettings(levels=["level"])), "value")


def _suspects_sink(spark, sf):
    sink, lines = fresh_path(spark, "sink"), fresh_path(spark, "predictions")
    settings = SuspectSettings(row_id="doc_id")
    write_suspects(M.mismatches(_scored_documents(spark, sf), "is_error", "pred_is_error"), sink, settings, lines)
    written = spark.read.parquet(sink).select("doc_id", "lang", "is_error", "pred_is_error")
    listed = read_csv(spark, lines, "index long, doc_id string, lang string, is_error boolean, pred_is_error boolean, "
                                    "pred_probs double")
    return written.join(listed.select("doc_id", F.col("index").alias("line")), "doc_id")


def _default_split(spark, sf):
    """Only a test frame is given, so it is the training frame too."""
    train, test = tag_split(None, table(spark, sf, "documents").select("doc_id", "source"))
    return train.unionByName(test)


def _feature_vector(spark, sf):
    """One place per category and the label number, from the fitted plan."""
    rows = settle(_items(spark, sf), "items").frame
    spec = X.FeatureSpec(text_columns=(), label_columns=("is_error",))
    ready = X.add_features(rows, X.fit_features(rows, spec))
    return ready.select("row_id", F.array_join(F.transform(
        vector_to_array("features"), lambda v: v.cast("int").cast("string")), "").alias("features"))


def _standard_scores(spark, sf):
    scored = X.standard_scores(table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice"),
                               ["p_size", "p_retailprice"])
    return scored.select("p_partkey", *[F.round(c, 6).alias(c) for c in ("p_size_z", "p_retailprice_z")])


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 9) for c in columns})


QUERIES = {
    "label_map": _label_map,
    "label_encode": _encoded,
    "label_encode_corrected": lambda s, d: _fixed(s, d).select(
        "row_id", *[f"correct_{c}_idx" for c in LEVELS]),
    "level_targets": _targets,
    "label_decode": _decoded,
    "category_index": lambda s, d: L.category_index(_items(s, d), ["color_desc", "size_desc"]),
    "zscore": _standard_scores,
    "train_test_split": _split_rows,
    "class_weights": lambda s, d: _rounded(M.class_weights(table(s, d, "labels"), "quality"), "weight"),
    "confusion": lambda s, d: _rounded(M.confusion(table(s, d, "labels"), "quality", "toxic"),
                                       "accuracy", "precision", "recall", "f1"),
    "level_accuracy": lambda s, d: _rounded(_level_accuracy(s, d), "accuracy"),
    "mismatches": lambda s, d: M.mismatches(_scored_documents(s, d), "is_error", "pred_is_error"),
    "top_suspects": lambda s, d: M.top_suspects(_scored_documents(s, d), "pred_probs", ["doc_id"]),
    "suspects_or_top": lambda s, d: M.suspects(
        _scored_documents(s, d).withColumn("pred_is_error", F.col("is_error")), "is_error", "pred_is_error",
        "pred_probs", ["doc_id"]),
    "suspect_types": _suspect_types,
    "embedding_error_scores": _embedding_scores("logistic"),
    "embedding_error_perceptron": _embedding_scores("perceptron"),
    "suspect_items": _suspect_items,
    "corrected_items": _corrected_items,
    "inference_metrics": _inference_metrics,
    "suspects_sink": _suspects_sink,
    "default_split": _default_split,
    "feature_vector": _feature_vector,
}

# ---- oracles ----------------------------------------------------------------------------------------------------


def _map_sql(source, columns):
    lines = " union all ".join(f"select '{c}' as column_name, {c} as value, row_id from {source}" for c in columns)
    return (f"select column_name, value, row_number() over (partition by column_name order by min(row_id), value) as "
            f"idx from ({lines}) where value is not null group by 1, 2 union all "
            f"select unnest([{', '.join(repr(c) for c in columns)}]), '<UNK>', 0")


def _encode_sql(source, column, out, base=None):
    return (f"coalesce((select m.idx from label_map m where m.column_name = '{base or column}' and m.value = "
            f"{source}.{column}), 0)::int as {out}")


_FIXED_SQL = (f"{branded_sql(True)}, fx as ({FIXED.replace('{rows}', 'nb')}), "
              f"label_map as ({_map_sql('fx', LEVELS)}), coded as (select row_id, is_error, "
              + ", ".join(_encode_sql("fx", c, f"{c}_idx") for c in LEVELS) + ", "
              + ", ".join(_encode_sql("fx", f"correct_{c}", f"correct_{c}_idx", c) for c in LEVELS) + " from fx)")
_DOCS = ("(select doc_id, lang, quality as is_error, toxic as pred_is_error, n_chars % 997 / 1000 as pred_probs "
         "from labels join documents using (doc_id))")
_RATES = ("(select count(*) filter (quality = 0 and toxic = 0) as tn, count(*) filter (quality = 0 and toxic = 1) as fp, "
          "count(*) filter (quality = 1 and toxic = 0) as fn, count(*) filter (quality = 1 and toxic = 1) as tp "
          "from labels)")


def _share(part, whole):
    return f"round(case when {whole} = 0 then 0.0::double else ({part})::double / ({whole}) end, 9)"


def _accuracy_sql(name, a, b):
    return (f"select '{name}' as level, count(*) as rows, round(avg(case when {a} is not distinct from {b} then "
            "1.0::double else 0.0 end), 9) as accuracy from nb where is_error = 0")


_BIN = ", ".join(f"('{m}', {v})" for m, v in (
    ("tn", "tn"), ("fp", "fp"), ("fn", "fn"), ("tp", "tp"), ("accuracy", _share("tn + tp", "tn + fp + fn + tp")),
    ("precision", _share("tp", "tp + fp")), ("recall", _share("tp", "tp + fn")),
    ("f1", _share("2 * tp", "2 * tp + fp + fn"))))

_HELD_OUT = ("select vec_id, (embedding[1] > 0)::int as is_error, true as follows, true as in_range, true as accurate "
             "from embeddings where vec_id % 4 = 1")

ORACLES = {
    "embedding_error_scores": _HELD_OUT,
    "embedding_error_perceptron": _HELD_OUT,
    "suspect_items": "select true as known_ids, true as all_or_none, true as listed, true as errors_found, "
                     "true as right_kept, true as follows, true as in_range",
    "corrected_items": f"{branded_sql(True)} select row_id, (row_id % 7 = 3)::int as is_error, true as follows, "
                       "true as in_range, true as real_path, " + ", ".join(f"true as better_{c}" for c in REPEATING)
                       + " from nb where row_id % 5 = 1",
    "inference_metrics": f"with r as (select * from {_RATES}) select m.metric, m.value::double as value from r, "
                         f"lateral (values {_BIN}) m(metric, value) union all select 'accuracy_level', "
                         "round(avg((doc_id % 3 <> 0)::int), 9) from labels where quality = 0",
    "suspects_sink": "select doc_id::varchar as doc_id, lang, is_error::boolean as is_error, pred_is_error::boolean as "
                     "pred_is_error, row_number() over (order by doc_id::varchar) - 1 as line "
                     f"from {_DOCS} where is_error <> pred_is_error",
    "default_split": "select doc_id, source, unnest(['train', 'test']) as split from documents",
    "feature_vector": f"{branded_sql(True)}, co as (select list_sort(list(distinct coalesce(color_desc, 'nan'))) as v "
                      "from nb), si as (select list_sort(list(distinct coalesce(size_desc, 'nan'))) as v from nb) "
                      "select row_id, array_to_string(list_transform(co.v, lambda x: (x = coalesce(color_desc, 'nan'))"
                      "::int), '') || array_to_string(list_transform(si.v, lambda x: (x = coalesce(size_desc, 'nan'))"
                      "::int), '') || is_error as features from nb, co, si",
    "label_map": f"{branded_sql(True)} {_map_sql('nb', GLOBAL_LEVELS)}",
    "label_encode": f"{branded_sql(True)}, seen as (select * from nb where hierarchy_level1_desc = 'FOOD'), "
                    f"label_map as ({_map_sql('seen', GLOBAL_LEVELS)}) select row_id, "
                    + ", ".join(_encode_sql("nb", c, f"{c}_idx") for c in GLOBAL_LEVELS) + " from nb",
    "label_encode_corrected": f"{_FIXED_SQL} select row_id, "
                              + ", ".join(f"correct_{c}_idx" for c in LEVELS) + " from coded",
    "level_targets": f"{_FIXED_SQL} select row_id, " + ", ".join(
        f"case when is_error = 1 then correct_{c}_idx else {c}_idx end as target_{c}" for c in LEVELS)
        + " from coded",
    "label_decode": f"{_FIXED_SQL} select row_id, " + ", ".join(
        f"(select m.value from label_map m where m.column_name = '{c}' and m.idx = coded.{c}_idx - 1) as pred_{c}"
        for c in LEVELS) + " from coded",
    "category_index": f"{branded_sql(True)} select column_name, value, row_number() over (partition by column_name "
                      "order by value) - 1 as idx from (select 'color_desc' as column_name, coalesce(color_desc, 'nan')"
                      " as value from nb union select 'size_desc', coalesce(size_desc, 'nan') from nb)",
    "zscore": "select p_partkey, " + ", ".join(
        f"round(({c} - avg({c}) over ()) / stddev_pop({c}) over (), 6) as {c}_z" for c in ("p_size", "p_retailprice"))
        + " from part",
    "train_test_split": "select *, case when doc_id % 5 = 0 then 'test' else 'train' end as split "
                        "from documents",
    "class_weights": "select label, n, round(sum(n) over () / (2.0 * greatest(n, 1)), 9)::double as weight from ("
                     "select l.label, count(labels.quality) as n from (select unnest([0, 1]) as label) l left join "
                     "labels on labels.quality = l.label group by 1)",
    "confusion": f"select tn, fp, fn, tp, {_share('tn + tp', 'tn + fp + fn + tp')} as accuracy, "
                 f"{_share('tp', 'tp + fp')} as precision, {_share('tp', 'tp + fn')} as recall, "
                 f"{_share('2 * tp', '2 * tp + fp + fn')} as f1 from {_RATES}",
    "level_accuracy": f"{branded_sql(True)} " + " union all ".join([
        _accuracy_sql("level5 vs level4", "global_hierarchy_level5_desc", "global_hierarchy_level4_desc"),
        _accuracy_sql("colour vs colour", "color_desc", "color_desc"),
        _accuracy_sql("brand vs brand", "local_brand_name", "global_brand_name")]),
    "mismatches": f"select * from {_DOCS} where is_error <> pred_is_error or is_error is null or pred_is_error is null",
    "top_suspects": f"select * from {_DOCS} order by pred_probs desc, doc_id limit 10",
    "suspects_or_top": f"select * replace (is_error as pred_is_error) from {_DOCS} order by pred_probs desc, doc_id "
                       "limit 10",
    "suspect_types": "select doc_id::varchar as doc_id, lang, is_error::boolean as is_error, pred_is_error::boolean as "
                     f"pred_is_error from {_DOCS}",
}

"""Text operators: tokens, chronological split, vocabulary / IDF, multinomial
naive Bayes, classification metrics and TF-IDF similarity.

Everything runs on whole texts as DataFrame jobs.  Scale notes:

* documents are reduced to ``(doc, token, tf)`` first (map-side partial
  aggregation), so a 20,000-word text never travels as text past the scan;
* the vocabulary is every token of the training documents; it grows with them,
  so terms meet it and the class x token weights by joins on the token, of which AQE splits hot
  tokens; nothing is broadcast by hint;
* the per-class dense term comes from an array with one entry per class (scalar subquery);
* similarity scores one query document against the corpus through a join on the
  query's own terms: linear in the corpus, no all-pairs, no row cap; many query documents go through
  the pruned search of ``operators.similarity``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# FIXED VALUES: tokens are lower-cased letter runs of length >= 2;
# Laplace smoothing alpha = 0.1; 80/20 split.
TOKEN_PATTERN = r"\p{L}{2,}"
ALPHA = 0.1
TRAIN_FRACTION = 0.8
# FIXED VALUES of the linear baseline: words of two or more letters, digits or underscores, a gram in at least
# three training documents, the 120,000 most frequent grams, inverse penalty 4, at most 1,000 steps, tolerance 1e-4.
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"
GRAM_LEAST_DF = 3
GRAM_FEATURES = 120_000
INVERSE_PENALTY = 4.0
MOST_STEPS = 1_000
TOLERANCE = 1e-4


def tokens(text: str | Column) -> Column:
    """Lower-cased Unicode letter runs of length >= 2 (array<string>)."""
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(t), F.lit(TOKEN_PATTERN), 0)


def doc_terms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, token, tf) for every token of every whole text.  Texts meet by document, so their tokens are counted
    where they are cut out: what is shuffled is the text once, not each occurrence with its key."""
    return (docs.select(id_col, text_col).repartition(id_col).select(id_col, F.explode(tokens(text_col)).alias("token"))
            .groupBy(id_col, "token").agg(F.count(F.lit(1)).alias("tf")))


def time_split(spark, docs: DataFrame, order: list[Column], fraction: float = TRAIN_FRACTION) -> DataFrame:
    """First floor(fraction * n) rows by ``order`` are training rows (exact,
    distributed rank; no single-partition window)."""
    from ..plans.common import global_rank
    ranked = global_rank(spark, docs, order, rank_col="split_rank")
    n = ranked.select(F.count(F.lit(1))).scalar()
    return ranked.withColumn("is_train", F.col("split_rank") <= F.floor(F.lit(fraction) * n))


def vocabulary(spark, train_terms: DataFrame, n_train: Column, size: int | None = None,
               id_col: str = "doc_id") -> DataFrame:
    """Every token with its training document frequency and smoothed idf =
    ln((1 + N) / (1 + df)) + 1; with ``size``, a user's choice, the most frequent ones (ties: token)."""
    from ..plans.common import global_rank
    df = train_terms.groupBy("token").agg(F.count(id_col).alias("df"))
    if size is not None:
        ranked = global_rank(spark, df, [F.col("df").desc(), F.col("token")], rank_col="vocab_rank")
        df = ranked.where(F.col("vocab_rank") <= size).select("token", "df")
    return df.withColumn("idf", F.log((1 + n_train) / (1 + F.col("df"))) + 1.0)


def naive_bayes_scores(terms: DataFrame, labels: DataFrame, vocab: DataFrame, alpha: float = ALPHA,
                       id_col: str = "doc_id", label_col: str = "label") -> DataFrame:
    """Multinomial naive Bayes log-joint for every (test doc, class).

    ``labels``: (id, label, is_train).  Returns (id, label, cls, logj).
    log p(c) + sum_w tf_w * log((n_cw + a) / (n_c + a V)) is evaluated as
    dense part  L_doc * (log a - log(n_c + a V))  plus the sparse part
    sum over tokens seen in class c of tf * (log(n_cw + a) - log a).
    """
    v_size = vocab.select(F.count(F.lit(1))).scalar()
    tv = terms.join(vocab.select("token"), "token")
    train = labels.where(F.col("is_train")).select(id_col, F.col(label_col).alias("cls"))
    test = labels.where(~F.col("is_train")).select(id_col, label_col)
    n_train = train.select(F.count(F.lit(1))).scalar()
    cnt = tv.join(train, id_col).groupBy("cls", "token").agg(F.sum("tf").alias("n_cw"))
    ctot = cnt.groupBy("cls").agg(F.sum("n_cw").alias("n_c"))
    cstat = (train.groupBy("cls").agg(F.count(F.lit(1)).alias("n_docs")).join(ctot, "cls", "left")
             .select("cls", F.log(F.col("n_docs") / n_train).alias("clp"),
                     (F.log(F.lit(alpha)) - F.log(F.coalesce("n_c", F.lit(0)) + alpha * v_size)).alias("dense")))
    # One entry per class (a bounded dimension: CPV divisions are two digits).
    classes = cstat.agg(F.collect_list(F.struct("cls", "clp", "dense"))).scalar()
    dl = (test.join(tv, id_col, "left").groupBy(id_col, label_col)
          .agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("n_tokens")))
    dense = (dl.select(id_col, label_col, "n_tokens", F.explode(classes).alias("c"))
             .select(id_col, label_col, F.col("c.cls").alias("cls"),
                     (F.col("c.clp") + F.col("n_tokens") * F.col("c.dense")).alias("d")))
    w = cnt.select("cls", "token", (F.log(F.col("n_cw") + alpha) - F.log(F.lit(alpha))).alias("w"))
    sparse = (tv.join(test.select(id_col), id_col, "left_semi").join(w, "token")
              .groupBy(id_col, "cls").agg(F.sum(F.col("tf") * F.col("w")).alias("s")))
    return (dense.join(sparse, [id_col, "cls"], "left")
            .select(id_col, label_col, "cls", (F.col("d") + F.coalesce("s", F.lit(0.0))).alias("logj")))


def posterior(scores: DataFrame, id_col: str = "doc_id", label_col: str = "label") -> DataFrame:
    """Softmax by the per-document max, class rank (ties: class label)."""
    w = W.partitionBy(id_col)
    s = scores.withColumn("_e", F.exp(F.col("logj") - F.max("logj").over(w)))
    s = s.withColumn("p", F.col("_e") / F.sum("_e").over(w))
    return s.withColumn("class_rank", F.row_number().over(w.orderBy(F.col("logj").desc(), "cls"))).drop("_e")


def predictions(post: DataFrame, id_col: str = "doc_id", label_col: str = "label") -> DataFrame:
    """Per test doc: predicted class, its posterior, p(assigned), top-3 hit."""
    return post.groupBy(id_col, label_col).agg(
        F.max_by("cls", F.when(F.col("class_rank") == 1, F.lit(1))).alias("pred"),
        F.max(F.when(F.col("class_rank") == 1, F.col("p"))).alias("confidence"),
        F.coalesce(F.max(F.when(F.col("cls") == F.col(label_col), F.col("p"))), F.lit(0.0)).alias("p_assigned"),
        F.bool_or((F.col("cls") == F.col(label_col)) & (F.col("class_rank") <= 3)).alias("in_top3"))


def classification_metrics(pred: DataFrame, all_labels: DataFrame, label_col: str = "label") -> DataFrame:
    """Accuracy, macro-F1 over all classes, top-3 accuracy, majority-class floor."""
    classes = all_labels.select(F.col(label_col).alias("c")).distinct()
    tp = pred.where(F.col("pred") == F.col(label_col)).groupBy(F.col(label_col).alias("c")).agg(
        F.count(F.lit(1)).alias("tp"))
    fp = pred.where(F.col("pred") != F.col(label_col)).groupBy(F.col("pred").alias("c")).agg(
        F.count(F.lit(1)).alias("fp"))
    fn = pred.where(F.col("pred") != F.col(label_col)).groupBy(F.col(label_col).alias("c")).agg(
        F.count(F.lit(1)).alias("fn"))
    per = classes.join(tp, "c", "left").join(fp, "c", "left").join(fn, "c", "left").na.fill(0, ["tp", "fp", "fn"])
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    per = per.withColumns({"prec": prec, "rec": rec})
    f1 = F.when(F.col("prec") + F.col("rec") > 0, 2 * F.col("prec") * F.col("rec") / (F.col("prec") + F.col("rec"))
                ).otherwise(0.0)
    macro = per.select(F.avg(f1)).scalar()
    floor = (pred.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
             .select(F.max("n")).scalar()) / pred.select(F.count(F.lit(1))).scalar()
    return pred.agg(F.count(F.lit(1)).alias("n_test"),
                    F.avg((F.col("pred") == F.col(label_col)).cast("double")).alias("accuracy"),
                    F.avg(F.col("in_top3").cast("double")).alias("top3_accuracy")).select(
        "n_test", "accuracy", macro.alias("macro_f1"), "top3_accuracy", floor.alias("majority_floor"))


def tfidf_vectors(terms: DataFrame, vocab: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc, token, weight): (1 + ln tf) * idf over vocabulary tokens, L2-normalised per doc."""
    tv = terms.join(vocab.select("token", "idf"), "token")
    return _unit_weights(tv, ["token"], id_col)


def _unit_weights(rows: DataFrame, kept: list[str], id_col: str) -> DataFrame:
    """(doc, kept..., weight) of rows with tf and idf.  The rows of a document, at most its different terms, meet once
    for their length; a null id is no document."""
    raw = rows.where(F.col(id_col).isNotNull()).select(id_col, *kept, ((1 + F.log("tf")) * F.col("idf")).alias("_v"))
    norm = F.sqrt(F.sum(F.col("_v") * F.col("_v")).over(W.partitionBy(id_col)))
    return raw.withColumn("_n", norm).select(
        id_col, *kept, F.when(F.col("_n") > 0, F.col("_v") / F.col("_n")).otherwise(F.col("_v")).alias("weight"))


def similar_to(vectors: DataFrame, query_id, k: int = 5, id_col: str = "doc_id") -> DataFrame:
    """Top-``k`` documents most similar to one query document (cosine of TF-IDF
    vectors; the query itself excluded; ties: later document first).

    The corpus vectors join the query's terms, so the work is linear in the corpus; the
    top-k is an ``orderBy().limit()`` (each task keeps k rows).  Documents that
    share no term score 0 and still fill the list when fewer than k overlap.
    For many query documents see ``operators.similarity``.
    """
    q = vectors.where(F.col(id_col) == query_id).select("token", F.col("weight").alias("qw"))
    scores = (vectors.where(F.col(id_col) != query_id).join(q, "token")
              .groupBy(id_col).agg(F.sum(F.col("weight") * F.col("qw")).alias("score")))
    zeros = (vectors.select(id_col).distinct().where(F.col(id_col) != query_id)
             .join(scores.select(id_col), id_col, "left_anti")
             .orderBy(F.col(id_col).desc()).limit(k).withColumn("score", F.lit(0.0)))
    # cosine of identical texts is 1 +- a few ulps: rank on 10 decimals so exact
    # duplicates tie and fall to the document-id tie-break
    order = [F.round("score", 10).desc(), F.col(id_col).desc()]
    top = scores.unionByName(zeros).orderBy(*order).limit(k)
    return top.select(F.lit(query_id).alias("query_id"), id_col, "score",
                      F.row_number().over(W.orderBy(*order)).cast("bigint").alias("rank"))


def gram_terms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, gram, tf): the words of every whole text and the pairs of neighbours among them."""
    texts = docs.select(id_col, text_col).repartition(id_col)  # as in doc_terms
    words = texts.select(id_col, F.regexp_extract_all(F.lower(text_col), F.lit(WORD_PATTERN), 0).alias("_w"))
    pairs = F.zip_with("_w", F.slice("_w", F.lit(2), F.greatest(F.size("_w"), F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    grams = F.concat("_w", F.filter(pairs, lambda g: g.isNotNull()))  # the last word has no neighbour
    return (words.select(id_col, F.explode(grams).alias("gram"))
            .groupBy(id_col, "gram").agg(F.count(F.lit(1)).alias("tf")))


def gram_vocabulary(spark, train_terms: DataFrame, n_train: Column, least_df: int = GRAM_LEAST_DF,
                    id_col: str = "doc_id") -> DataFrame:
    """(gram, gram_id, df, idf) of every gram in ``least_df`` training documents or more.

    Ids run from 0 without gaps, the most frequent gram (by all its occurrences; ties: the gram) first:
    a distributed rank, no hashing, so every gram is a feature of its own and a smaller
    vocabulary is a cut of the ids.
    """
    from ..plans.common import global_rank
    counted = (train_terms.groupBy("gram").agg(F.count(id_col).alias("df"), F.sum("tf").alias("_n"))
               .where(F.col("df") >= least_df))
    ranked = global_rank(spark, counted, [F.col("_n").desc(), F.col("gram")], rank_col="_r")
    return ranked.select("gram", (F.col("_r") - 1).alias("gram_id"), "df",
                         (F.log((1 + n_train) / (1 + F.col("df"))) + 1.0).alias("idf"))


def gram_weights(terms: DataFrame, vocab: DataFrame, size: int = GRAM_FEATURES, id_col: str = "doc_id") -> DataFrame:
    """(doc, gram_id, weight): (1 + ln tf) * idf over the first ``size`` grams, L2-normalised per doc.

    The known grams are ``size`` rows at most, however many texts there are: they are sent to the terms, so
    that only numbers of known grams are shuffled, once, by document."""
    known = vocab.where(F.col("gram_id") < size).select("gram", "gram_id", "idf")
    return _unit_weights(terms.join(F.broadcast(known), "gram"), ["gram_id"], id_col)


def sparse_features(docs: DataFrame, weights: DataFrame, size: int, write, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with their weights as a sparse ``features`` vector (empty without any).

    Entries meet by document; the table that ``write(df, schema)`` makes of them is read back as
    vectors, which Parquet stores as just these four fields, so no Python code builds them.
    """
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import StructField, StructType
    entries = weights.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(F.col("gram_id").cast("int").alias("i"), "weight"))).alias("_e"))
    e = F.coalesce("_e", F.array().cast("array<struct<i:int,weight:double>>"))
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
                      F.transform(e, lambda x: x["i"]).alias("indices"), F.transform(e, lambda x: x["weight"]).alias("values"))
    rows = docs.join(entries, id_col, "left").select(*docs.columns, vector.alias("features"))
    return write(rows, StructType([*rows.schema.fields[:-1], StructField("features", VectorUDT())]))

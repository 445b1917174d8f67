"""Spam filter: ingest, tokens, splits, naive Bayes training and test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import text as T
from tallyloom.functions.vectors import first_argmax
from tallyloom.operators import metrics, sampling
from tallyloom.operators import naive_bayes as nb
from tallyloom.operators.ranking import shuffled_rank
from tallyloom.plans.views import mail, reviews, table
from tallyloom.session import materialize, scratch
from tallyloom.sources.mail import decode_messages, ingest, read_label_index, read_messages, write_messages

CLASSES = ("ham", "spam")
SEED = 2021
TEST_RATIO = 0.1
FOLDS = 5
RATES = (0.05, 0.5, 1.0)


def class_index(label: Column, classes: Sequence[str] = CLASSES) -> Column:
    """Position of a label in the ordered class list."""
    return (F.array_position(F.array(*[F.lit(c) for c in classes]), label) - 1).cast("int")


# ---- ingest -----------------------------------------------------------------


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RFC 822 messages ``(path, content)`` made from mail and pages.

    Mail comes in four shapes (plain, plain+html, html+plain, unknown charset),
    pages are html-only messages without a sender.
    """
    nl = F.lit("\r\n")

    def part(kind: str, charset: str, body: Column) -> Column:
        head = F.lit(f"Content-Type: text/{kind}; charset={charset}\r\nContent-Transfer-Encoding: base64\r\n\r\n")
        return F.concat(head, F.base64(F.encode(body, "UTF-8")), nl)

    def multipart(*parts: Column) -> Column:
        head = F.lit('MIME-Version: 1.0\r\nContent-Type: multipart/alternative; boundary="edge"\r\n\r\n')
        return F.concat(head, *[c for p in parts for c in (F.lit("--edge\r\n"), p)], F.lit("--edge--\r\n"))

    messages = mail(spark, sf_dir, labelled=False)
    body, html = F.col("body"), F.concat(F.lit("<p>"), F.col("body"), F.lit("</p>"))
    shape = F.col("doc_id") % 4
    composed = (
        F.when(shape == 0, F.concat(F.lit("MIME-Version: 1.0\r\n"), part("plain", "utf-8", body)))
        .when(shape == 1, multipart(part("plain", "x-unknown", body), part("html", "utf-8", html)))
        .when(shape == 2, multipart(part("html", "utf8", html), part("plain", "utf-8", body)))
        .otherwise(F.concat(F.lit("MIME-Version: 1.0\r\n"), part("plain", "no-such-charset", body)))
    )
    mails = messages.select(
        F.concat(F.lit("data/"), F.col("doc_id").cast("string")).alias("path"),
        F.encode(F.concat(F.lit("From: Writer <"), F.col("sender"), nl, composed), "UTF-8").alias("content"),
    )
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("pages/"), F.col("page_id").cast("string")).alias("path"),
        F.encode(F.concat(F.lit("MIME-Version: 1.0\r\n"), part("html", "UTF-8", F.col("html"))), "UTF-8").alias("content"),
    )
    return mails.unionByName(pages)


def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label index, written as text lines and read back."""
    path = scratch(spark, "label-index")
    line = F.concat_ws(" ", "label", F.concat(F.lit("../data/"), F.col("doc_id").cast("string")))
    mail(spark, sf_dir).select(line.alias("value")).write.text(path)
    return read_label_index(spark, path)


def src_label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_index(spark, sf_dir)


def mail_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages, one file each, written and scanned: ``(path, content)``."""
    path = scratch(spark, "mail-files")
    named = F.split("path", "/")
    content = F.decode("content", "UTF-8")
    write_messages(
        raw_messages(spark, sf_dir).select(F.get(named, F.lit(0)).alias("folder"), F.get(named, F.lit(1)).alias("name"), content.alias("content")),
        path,
    )
    return read_messages(spark, path).withColumn("path", F.regexp_replace("path", r"^.*/folder=([^/]*)/name=([^/]*)/[^/]*$", "$1/$2"))


def fingerprints(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "path",
        T.sender_feature(F.col("sender")).alias("sender"),
        F.length("body").alias("n_chars"),
        F.md5(F.col("body").cast("binary")).alias("body_md5"),
    )


def mail_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(decode_messages(raw_messages(spark, sf_dir)))


def mail_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages, read from one file each."""
    return fingerprints(decode_messages(mail_files(spark, sf_dir)))


def mail_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(counter, n)``: messages, those without a sender, and those not decodable, counted while they are ingested."""
    seen = Observation()
    materialize(decode_messages(mail_files(spark, sf_dir), seen), "ingested")
    return spark.createDataFrame(sorted(seen.get.items()), "counter string, n bigint")


def index_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = ingest(label_index(spark, sf_dir), raw_messages(spark, sf_dir))
    return labelled.select(
        "path",
        "label",
        F.size(T.mail_features(F.col("sender"), F.col("body"))).alias("n_features"),
    )


# ---- text features ----------------------------------------------------------


def sender_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    sender = F.col("sender")
    return mail(spark, sf_dir, labelled=False).select(
        "doc_id",
        T.sender_feature(sender, "domain").alias("domain"),
        T.sender_feature(sender, "full").alias("full_address"),
        T.sender_feature(sender, "none").alias("no_sender"),
    )


def ascii_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = T.ascii_only(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.length(kept).alias("n_kept"), F.md5(kept.cast("binary")).alias("kept_md5")
    )


def word_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = table(spark, sf_dir, "documents").select(F.explode(T.mail_tokens(F.col("text"))).alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("n"))


def mail_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = mail(spark, sf_dir, labelled=False).select("doc_id", T.mail_features(F.col("sender"), F.col("body")).alias("f"))
    return features.select(
        "doc_id",
        F.size("f").alias("n_features"),
        F.get("f", F.lit(0)).alias("first_feature"),
        F.md5(F.array_join("f", " ").cast("binary")).alias("features_md5"),
    )


def label_to_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mail(spark, sf_dir).select("doc_id", "label", class_index(F.col("label")).alias("class_id"))


# ---- sampling and splitting -------------------------------------------------


def seeded_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shuffled_rank(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SEED, "rk")


def sample_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return sampling.sample_fraction(docs, "doc_id", 0.5, SEED)


def holdout_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_mail(spark, sf_dir).select("doc_id", "label", "is_test")


def holdout_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.holdout_head(reviews(spark, sf_dir).select("doc_id", "overall"), "doc_id", 0.9, SEED)


def kfold_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.kfold(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 7, SEED)


def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.first_shuffled(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 500, SEED)


def folded_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.kfold(mail(spark, sf_dir), "doc_id", FOLDS, SEED)


def kfold_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "folds")
    folded_mail(spark, sf_dir).write.partitionBy("fold").parquet(path)
    return spark.read.schema("doc_id bigint, label string, sender string, body string, fold int").parquet(path).select(
        "doc_id", "label", "sender", F.length("body").alias("n_chars"), "fold"
    )


def fold_train_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = folded_mail(spark, sf_dir).select("doc_id", "label", "fold")
    return folded.join(folded.where("fold = 0").select("doc_id"), "doc_id", "left_anti").select("doc_id", "label")


def fold_train_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows of fold 2: those before its block and those behind it."""
    folded = folded_mail(spark, sf_dir).select("doc_id", "label", "fold")
    return folded.where("fold < 2").unionByName(folded.where("fold > 2 or fold is null")).select("doc_id", "label")


# ---- counts -----------------------------------------------------------------


def mail_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nb.occurrences(mail(spark, sf_dir), "doc_id", T.mail_features(F.col("sender"), F.col("body")), ["label"])


def label_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = mail(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n"))
    classes = spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in CLASSES])).alias("label"))
    return classes.join(counts, "label", "left").select("label", F.coalesce("n", F.lit(0)).alias("n"))


def class_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = T.mail_features(F.col("sender"), F.col("body"))
    return mail(spark, sf_dir).select("doc_id", "label", F.posexplode(features).alias("pos", "token"))


def token_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_class = [F.count_if(F.col("label") == c).alias(f"n_{c}") for c in CLASSES]
    return mail_occurrences(spark, sf_dir).groupBy("token").agg(*per_class)


def whole_mail_model(spark: SparkSession, sf_dir: str) -> nb.Model:
    whole = [nb.Variant("all", F.lit(True), F.lit(True))]
    return nb.fit(mail(spark, sf_dir), mail_occurrences(spark, sf_dir), "label", CLASSES, whole)


def class_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = mail(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("label", "n", F.round(F.col("n") / total, 9).alias("p"))


def cond_prob(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = whole_mail_model(spark, sf_dir)
    shares = nb.token_probabilities(model)
    return model.tokens.select("token", *[F.round(s, 12).alias(f"p_{c}") for c, s in zip(CLASSES, shares)])


def nb_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, tokens, runs = holdout_inputs(spark, sf_dir)
    model = nb.fit(docs, tokens, "label", CLASSES, runs)
    names = model.counts()
    tokens_part = model.tokens.select("token", *[F.col(n).alias(f"n_{c}") for c, n in zip(CLASSES, names)])
    prior_part = model.priors.select(
        F.lit(None).cast("string").alias("token"), *[F.col(n).alias(f"n_{c}") for c, n in zip(CLASSES, names)]
    )
    return tokens_part.unionByName(prior_part)


# ---- training and test ------------------------------------------------------


def split_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.holdout_tail(mail(spark, sf_dir), "doc_id", TEST_RATIO, SEED)


def holdout_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[nb.Variant]]:
    docs = split_mail(spark, sf_dir)
    tokens = nb.occurrences(docs, "doc_id", T.mail_features(F.col("sender"), F.col("body")), ["label", "is_test"])
    return docs, tokens, [nb.Variant("holdout", ~F.col("is_test"), F.col("is_test"))]


def scored(docs: DataFrame, tokens: DataFrame, runs: list[nb.Variant]) -> DataFrame:
    model = nb.fit(docs, tokens, "label", CLASSES, runs)
    return nb.score(docs, tokens, model, "doc_id", "label", runs)


def predicted(scores: DataFrame) -> DataFrame:
    return scores.select(
        "doc_id", "variant", class_index(F.col("label")).alias("label_id"), first_argmax(F.col("scores")).alias("pred")
    )


def nb_token_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, tokens, runs = holdout_inputs(spark, sf_dir)
    model = nb.fit(docs, tokens, "label", CLASSES, runs)
    counts = nb.counted(tokens.where("is_test"))
    logs = nb.token_log_probabilities(counts, model, "doc_id")
    return logs.select(
        "doc_id", "token", "m", F.round("lp_0_0", 6).alias("lp_ham"), F.round("lp_0_1", 6).alias("lp_spam")
    )


def nb_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(*holdout_inputs(spark, sf_dir)).select(
        "doc_id",
        "label",
        F.round(F.get("scores", F.lit(0)), 4).alias("s_ham"),
        F.round(F.get("scores", F.lit(1)), 4).alias("s_spam"),
    )


def nb_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicted(scored(*holdout_inputs(spark, sf_dir))).select("doc_id", "label_id", "pred")


def rounded(df: DataFrame, names: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


MEASURES = ["accuracy", "precision", "recall", "f1"]


def report(scores: DataFrame) -> DataFrame:
    return metrics.binary_report(predicted(scores), "pred", "label_id", ["variant"])


def nb_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job: hold-out, training, test, quality."""
    return rounded(report(scored(*holdout_inputs(spark, sf_dir))).drop("variant"), MEASURES)


def fold_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All folds in one job: counts of a fold's training data are the other folds' counts."""
    docs = folded_mail(spark, sf_dir)
    tokens = nb.occurrences(docs, "doc_id", T.mail_features(F.col("sender"), F.col("body")), ["label", "fold"])
    docs = materialize(docs.select("doc_id", "label", "fold"), "folds")
    fold = F.col("fold")
    runs = [nb.Variant(str(i), sampling.in_training(fold, i), F.coalesce(fold == i, F.lit(False))) for i in range(FOLDS)]
    return report(scored(docs, tokens, runs))


def nb_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    folds = fold_report(spark, sf_dir)
    return rounded(folds.select(F.col("variant").cast("int").alias("fold"), *MEASURES), MEASURES)


def fold_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.mean_over(fold_report(spark, sf_dir), MEASURES), ["value"])


def nb_rate_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training on growing samples of the training data, same test data."""
    docs = split_mail(spark, sf_dir)
    train = docs.where(~F.col("is_test"))
    docs = sampling.rate_part(docs, "doc_id", list(RATES), SEED + 1, "part", train)
    tokens = nb.occurrences(
        docs, "doc_id", T.mail_features(F.col("sender"), F.col("body")), ["label", "is_test", "part"]
    )
    docs = materialize(docs.select("doc_id", "label", "is_test", "part"), "sampled")
    runs = [
        nb.Variant(str(rate), ~F.col("is_test") & (F.col("part") <= i), F.col("is_test")) for i, rate in enumerate(RATES)
    ]
    sweep = report(scored(docs, tokens, runs))
    return rounded(sweep.select(F.col("variant").cast("double").alias("rate"), *MEASURES), MEASURES)


def nb_sender_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mail domain, full address or no sender as a feature, counted in one job."""
    docs = split_mail(spark, sf_dir)

    def tagged(kind: str, tokens: Column) -> Column:
        return F.transform(tokens, lambda t: F.struct(t.alias("token"), F.lit(kind).alias("kind")))

    def sender_array(mode: str) -> Column:
        feature = T.sender_feature(F.col("sender"), mode)
        return F.filter(F.array(feature), lambda s: s != "")

    features = F.concat(
        tagged("body", T.mail_tokens(F.col("body"))),
        tagged("domain", sender_array("domain")),
        tagged("full", sender_array("full")),
    )
    tokens = nb.occurrences(docs, "doc_id", features, ["label", "is_test"])
    runs = [
        nb.Variant(mode, ~F.col("is_test"), F.col("is_test"), F.col("kind").isin("body", mode)) for mode in T.SENDER_MODES
    ]
    return rounded(report(scored(docs, tokens, runs)).withColumnRenamed("variant", "mode"), MEASURES)


def pred_label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    preds = predicted(scored(*holdout_inputs(spark, sf_dir))).select("doc_id", "pred")
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("label"))
    return metrics.aligned(preds, labels, "doc_id")


def quality_against_toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict bad quality from toxicity: a two-class prediction over all labels."""
    return table(spark, sf_dir, "labels").select(F.col("toxic").alias("pred"), (1 - F.col("quality")).alias("label"))


def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = quality_against_toxic(spark, sf_dir)
    return pairs.agg(F.round(metrics.accuracy(F.col("pred"), F.col("label")), 9).alias("accuracy"))


def confusion_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.binary_counts(quality_against_toxic(spark, sf_dir), "pred", "label").drop("accuracy")


def prf_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = quality_against_toxic(spark, sf_dir)
    return rounded(metrics.binary_report(pairs, "pred", "label").drop("accuracy"), MEASURES[1:], 9)


QUERIES = {
    "src_label_index": src_label_index,
    "mail_ingest": mail_ingest,
    "mail_scan": mail_scan,
    "mail_faults": mail_faults,
    "index_join": index_join,
    "sender_domain": sender_domain,
    "ascii_filter": ascii_filter,
    "word_tokens": word_tokens,
    "mail_features": mail_features,
    "label_index": label_to_index,
    "seeded_shuffle": seeded_shuffle,
    "sample_fraction": sample_fraction,
    "holdout_tail": holdout_tail,
    "holdout_head": holdout_head,
    "kfold_assign": kfold_assign,
    "sample_rows": sample_rows,
    "kfold_write": kfold_write,
    "fold_train_anti": fold_train_anti,
    "fold_train_union": fold_train_union,
    "label_freq": label_freq,
    "class_tokens": class_tokens,
    "token_freq": token_freq,
    "class_prior": class_prior,
    "cond_prob": cond_prob,
    "nb_params": nb_params,
    "nb_token_join": nb_token_join,
    "nb_scores": nb_scores,
    "nb_predict": nb_predict,
    "nb_metrics": nb_metrics,
    "nb_kfold": nb_kfold,
    "fold_average": fold_average,
    "nb_rate_sweep": nb_rate_sweep,
    "nb_sender_ablation": nb_sender_ablation,
    "pred_label_join": pred_label_join,
    "accuracy": accuracy,
    "confusion_binary": confusion_binary,
    "prf_binary": prf_binary,
}

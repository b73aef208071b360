"""Secret scans by an incremental ledger of blobs.

Every version of every document is addressed by the digest of its content. The ledger is a table
of (blob, rule, version, spans): a pair of blob and rule version that it holds is never scanned
again, whether the same content comes back in another document or in a later run. Findings are
then joined back to all documents that have the content. Copies meet before the scan, by an
aggregation that keeps one text per digest in every task first, so a text that makes up a third
of all rows is sent once per task.

A rule's matches are the leftmost non-overlapping ones, kept where the checked group is long
enough. Positions are code points: a text is split at the matches, and lengths are summed over the
matches of a blob and rule. To redact, a text is cut into blocks of bounded length, each of which
gets the spans that reach into it. Both take time linear in the text, however many secrets it holds.

Defined cases: null text is empty, and without findings; repeated rows give repeated results;
rows of one doc_id with different texts are different versions, each with its own result; columns
beyond doc_id and text are ignored. The ledger grows by one row for each new blob and rule.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import sha256_hex, shared_path, unused

LEDGER = "blob BINARY, rule STRING, version INT, spans ARRAY<STRUCT<start: INT, stop: INT>>"


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: The group whose length counts, and its least length.
    group: int
    least: int
    version: int = 1


RULES = (
    Rule(
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
        r"([A-Za-z0-9+/_.=-]+)",
        group=1,
        least=6,
    ),
    Rule("access", "AKIA[A-Z0-9]+", group=0, least=20),
    Rule("hex", "[0-9a-f]+", group=0, least=24),
)
#: What is looked for beyond the base rules: keys, providers' tokens, signed web tokens, logins.
MORE_RULES = (
    Rule(
        "private_key",
        r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=:,\x20\x09\x0A\x0D]+"
        r"-----END [A-Z ]*PRIVATE KEY-----",
        group=0,
        least=60,
    ),
    Rule(
        "provider",
        r"(?:gh[pousr]_|github_pat_|glpat-|xox[abeprs]-|[sr]k_live_|npm_|AIza)[A-Za-z0-9_-]+",
        group=0,
        least=20,
    ),
    Rule(
        "web_token",
        r"eyJ[A-Za-z0-9_-]{5,500}\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+",
        group=0,
        least=30,
    ),
    Rule(
        "login_url",
        r"[A-Za-z][A-Za-z0-9+.-]{0,30}://[^\x00-\x20:@/]+:[^\x00-\x20:@/]+@[A-Za-z0-9.-]+",
        group=0,
        least=12,
    ),
)
ALL_RULES = RULES + MORE_RULES
#: Code points of a block of a text that is redacted.
BLOCK = 4096


def match_sizes(text: Column, rule: Rule) -> Column:
    """Of every match the length of the gap before it, its own, and whether it is long enough."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    sizes = F.transform(
        F.arrays_zip(
            F.split(text, rule.pattern, -1).alias("gap"),
            matches.alias("match"),
            checked.alias("checked"),
        ),
        lambda m: F.struct(
            F.length(m["gap"]).alias("gap"),
            F.length(m["match"]).alias("size"),
            (F.length(m["checked"]) >= rule.least).alias("long"),
        ),
    )
    none = F.array().cast("array<struct<gap: int, size: int, long: boolean>>")
    # most texts hold no match: they are not split
    return F.when(F.regexp_like(text, F.lit(_ample(rule))), sizes).otherwise(none)


def _spans(sizes: DataFrame) -> DataFrame:
    """Blob, rule, version and the spans of matches that are long enough, from their sizes.

    The rows lie by blob already; matches of a blob and rule are summed in their order.
    """
    keys = ("blob", "rule", "version")
    rows = sizes.select(*keys, F.posexplode_outer("sizes").alias("at", "m"))
    so_far = Window.partitionBy(*keys).orderBy("at")
    stop = F.sum(F.col("m.gap") + F.col("m.size")).over(so_far).cast("int")
    rows = rows.select(*keys, "m", stop.alias("stop"))
    span = F.struct((F.col("stop") - F.col("m.size")).alias("start"), F.col("stop").alias("stop"))
    found = F.collect_list(F.when(F.col("m.long"), span))
    return rows.groupBy(*keys).agg(F.sort_array(found).alias("spans"))


def _ample(rule: Rule) -> str:
    """Matches somewhere in every text that has a match long enough; without backtracking."""
    if rule.group == 0 and rule in RULES:
        return rule.pattern.removesuffix("+") + f"{{{rule.least - len(_literal(rule))}}}"
    return rule.pattern


def _literal(rule: Rule) -> str:
    return rule.pattern.partition("[")[0]


def _versions(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select("doc_id", text.alias("text")).withColumn(
        "blob", F.unhex(sha256_hex(F.col("text")))
    )


def read_ledger(spark, path: str) -> DataFrame:
    """The ledger at the path; an empty one where there is none yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def update_ledger(documents: DataFrame, path: str, rules: tuple[Rule, ...] = ALL_RULES) -> DataFrame:
    """Scan what the ledger does not hold yet, append it, and return the whole ledger."""
    spark = documents.sparkSession
    blobs = _versions(documents).groupBy("blob").agg(F.first("text").alias("text"))
    seen = (
        read_ledger(spark, path)
        .groupBy("blob")
        .agg(F.collect_set(F.struct("rule", "version")).alias("seen"))
    )
    todo = F.array(*[_name(r) for r in rules])
    left = F.array_except(todo, F.coalesce("seen", F.slice(todo, 1, 0))).alias("left")
    unseen = blobs.join(seen, "blob", "left").select("blob", "text", left)
    entries = F.array(
        *[
            F.when(
                F.array_contains("left", _name(r)),
                F.struct(
                    F.lit(r.kind).alias("rule"),
                    F.lit(r.version).alias("version"),
                    match_sizes(F.col("text"), r).alias("sizes"),
                ),
            )
            for r in rules
        ]
    )
    sizes = unseen.where(F.size("left") > 0).select(
        "blob", F.explode(F.array_compact(entries)).alias("e")
    )
    _spans(sizes.select("blob", "e.*")).write.mode("append").parquet(path)
    return read_ledger(spark, path)


def _name(rule: Rule) -> Column:
    return F.struct(F.lit(rule.kind).alias("rule"), F.lit(rule.version).alias("version"))


def findings(current: DataFrame, rules: tuple[Rule, ...] = ALL_RULES) -> DataFrame:
    """Of each blob with secrets, the spans that the rules' present versions found, in order."""
    rank = F.coalesce(*[F.when(F.col("rule") == r.kind, F.lit(i)) for i, r in enumerate(rules)])
    wanted = F.struct("rule", "version").isin(*[_name(r) for r in rules])
    spans = F.transform(
        "spans",
        lambda s: F.struct(
            s["start"].alias("start"),
            rank.alias("rank"),
            s["stop"].alias("stop"),
            F.col("rule").alias("kind"),
        ),
    )
    return (
        current.where(wanted & (F.size("spans") > 0))
        .groupBy("blob")
        .agg(F.collect_set(spans).alias("spans"))
        .select("blob", F.sort_array(F.flatten("spans")).alias("spans"))
    )


def scan(
    documents: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = ALL_RULES
) -> DataFrame:
    """Per document row, its ``spans`` (start, rank of the rule, end, kind) in order of the text.

    Without a ledger's path, a new ledger is begun in the shared folder.
    """
    path = ledger or shared_path(documents.sparkSession, "ledger")
    found = findings(update_ledger(documents, path, rules), rules)
    none = F.array().cast(found.schema["spans"].dataType)
    return (
        _versions(documents)
        .select("doc_id", "blob")
        .join(found, "blob", "left")
        .select("doc_id", "blob", F.coalesce("spans", none).alias("spans"))
    )


def redact(
    documents: DataFrame,
    ledger: str | None = None,
    rules: tuple[Rule, ...] = ALL_RULES,
    mark: str = "[SECRET]",
) -> DataFrame:
    """The rows, with ``mark`` in the place of every secret; spans that overlap get one mark.

    A column n_chars, where there is one, follows the text.
    """
    path = ledger or shared_path(documents.sparkSession, "ledger")
    found = findings(update_ledger(documents, path, rules), rules)
    key, clean = unused(documents, "blob"), unused(documents, "clean")
    texts = _versions(documents).join(found, "blob").groupBy("blob")
    texts = texts.agg(F.first("text").alias("text"), F.first("spans").alias("spans"))
    cleaned = _redacted(texts, mark).select(F.col("blob").alias(key), F.col("text").alias(clean))
    blob = F.unhex(sha256_hex(F.coalesce(documents["text"], F.lit(""))))
    out = documents.join(cleaned, blob == F.col(key), "left")
    out = out.withColumn("text", F.coalesce(clean, "text"))
    if "n_chars" in documents.columns:
        n = F.when(F.col(clean).isNotNull(), F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", n.cast(documents.schema["n_chars"].dataType))
    return out.select(*documents.columns)


def _redacted(texts: DataFrame, mark: str) -> DataFrame:
    """Blob and text, with a mark for each run of spans that overlap."""
    spans = texts.select("blob", F.explode("spans").alias("s")).select("blob", "s.start", "s.stop")
    order = Window.partitionBy("blob").orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", (before.isNull() | (F.col("start") >= before)).cast("int"))
    spans = spans.withColumn("run", F.sum("new").over(order))
    runs = spans.groupBy("blob", "run").agg(F.min("start").alias("a"), F.max("stop").alias("b"))
    first, last = (F.floor(c / BLOCK).cast("int") for c in (F.col("a"), F.col("b") - 1))
    cuts = runs.select("blob", "a", "b", F.explode(F.sequence(first, last)).alias("no"))
    base = F.col("no") * BLOCK
    cut = F.struct(
        F.greatest(F.col("a") - base, F.lit(0)).alias("low"),
        F.least(F.col("b") - base, F.lit(BLOCK)).alias("high"),
        F.when(F.col("a") >= base, F.lit(mark)).otherwise("").alias("mark"),
    )
    cuts = cuts.groupBy("blob", "no").agg(F.sort_array(F.collect_list(cut)).alias("cuts"))
    pattern = F.lit(f"(?s).{{1,{BLOCK}}}")
    blocks = texts.select(
        "blob",
        F.posexplode(F.regexp_extract_all("text", pattern, F.lit(0))).alias("no", "block"),
    )

    def step(state: Column, c: Column) -> Column:
        gap = F.substring(F.col("block"), state["at"] + 1, c["low"] - state["at"])
        return F.struct(c["high"].alias("at"), F.concat(state["out"], gap, c["mark"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = F.aggregate(
        "cuts",
        start,
        step,
        lambda s: F.concat(s["out"], F.substring(F.col("block"), s["at"] + 1, F.lit(BLOCK))),
    )
    part = F.when(F.col("cuts").isNull(), F.col("block")).otherwise(rest)
    parts = blocks.join(cuts, ["blob", "no"], "left").select("blob", "no", part.alias("part"))
    ordered = F.sort_array(F.collect_list(F.struct("no", "part")))
    whole = F.array_join(F.transform(ordered, lambda p: p["part"]), "")
    return parts.groupBy("blob").agg(whole.alias("text"))


def digests(scanned: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as text."""
    base = [r.kind for r in RULES]

    def listed(spans: Column) -> Column:
        texts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"]))
        return F.array_join(texts, ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    own = F.filter("spans", lambda s: s["kind"].isin(base))
    return scanned.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in base],
        sha256_hex(listed(own)).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )

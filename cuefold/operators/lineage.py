"""A ledger of runs: what each step read, wrote and was set to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = "ledger_run_id string, step string, started_at timestamp, finished_at timestamp, output_path string, inputs map<string,string>, settings map<string,string>, stats map<string,string>"


def run_id(ledger_id: Column) -> Column:
    """The short id of a run: ``r`` and the first eight digits of the ledger id's SHA-1."""
    return F.concat(F.lit("r"), F.substring(F.sha1(ledger_id), 1, 8))


def elapsed(ledger: DataFrame) -> DataFrame:
    """The ledger with ``run_id`` and ``elapsed_ms``; an unfinished run has none."""
    ms = F.unix_millis("finished_at") - F.unix_millis("started_at")
    return ledger.withColumn("run_id", run_id(F.col("ledger_run_id"))).withColumn("elapsed_ms", ms)


def latest_outputs(ledger: DataFrame) -> DataFrame:
    """The last run of each output path; of equal times the greater ledger id."""
    every = F.struct(*ledger.columns)
    return ledger.filter("output_path IS NOT NULL").groupBy("output_path").agg(F.max_by(every, F.struct("started_at", "ledger_run_id")).alias("r")).select("r.*")


def preferred(ledger: DataFrame) -> DataFrame:
    """``step, output_path``: for each step the output written last, the one to reuse."""
    return ledger.filter("finished_at IS NOT NULL AND output_path IS NOT NULL").groupBy("step").agg(F.max_by("output_path", F.struct("finished_at", "ledger_run_id")).alias("output_path"))


def pending(chunks: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """The chunks still to do: those without a result that has text and no error."""
    done = results.filter("length(trim(text)) > 0 AND error IS NULL").select(key).distinct()
    return chunks.join(done, key, "left_anti")


def started(ledger_id: Column, parent_run: Column | None = None) -> Column:
    """The run id of a new run: its parent's, if it has one, else its own."""
    own = run_id(ledger_id)
    return own if parent_run is None else F.coalesce(parent_run, own)


def manifest_hash(fields: list[str]) -> Column:
    """What a checkpoint's settings are, as one digest; null and missing differ from empty."""
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


def resumable(state: DataFrame, current: str, manifest: str = "manifest") -> DataFrame:
    """The rows of a checkpoint that were made under the ``current`` manifest digest; any other row is an error when read."""
    return state.withColumn(manifest, F.when(F.col(manifest) == current, F.col(manifest)).otherwise(F.raise_error(F.lit("the checkpoint was made with other settings")))).filter(F.col(manifest) == current)


def to_do(chunks: DataFrame, results: DataFrame, key: str, status: str) -> DataFrame:
    """As :func:`pending`; a finished chunk whose ``status`` is red is an error when read, as later chunks build on it."""
    red = results.filter(f"length(trim(text)) > 0 AND error IS NULL AND {status} = 'red'").agg(F.count(F.lit(1)).alias("_red"))
    left = pending(chunks, results, key).crossJoin(F.broadcast(red))  # one row
    return left.filter(F.when(F.col("_red") == 0, True).otherwise(F.raise_error(F.lit("finished chunks are red")).cast("boolean"))).drop("_red")


def retry_reason(attempt: Column, error: Column, status: Column) -> Column:
    """Whether a chunk is tried once more, and why: after a passing error, or for quality; null where not, as after a second attempt."""
    return F.when(attempt >= 2, None).when(error.isin("transient", "timeout", "no_progress"), "error").when(error.isNull() & (status == "red"), "quality")


def usage_totals(usage: DataFrame, keys: list[str], prices: dict[str, tuple[float, float]]) -> DataFrame:
    """``keys, input_tokens, output_tokens, cost``: tokens and their price a million, by the first entry that the model's name holds; a model without a price has no cost."""
    from ..functions.rules import token_cost

    paid = usage.withColumn("_c", token_cost(F.col("input_tokens"), F.col("model"), {k: v[0] for k, v in prices.items()}) + token_cost(F.col("output_tokens"), F.col("model"), {k: v[1] for k, v in prices.items()}))
    return paid.groupBy(*keys).agg(F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.sum("_c").alias("cost"))


def first_ids(rows: DataFrame, keys: list[str], order: str, most: int = 8) -> DataFrame:
    """``keys, n, ids``: how many rows and the first few by ``order``; kept small while counting, so that a key of any size is one row."""
    from pyspark.sql import Window

    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
    few = ranked.filter(F.col("_r") <= most).groupBy(*keys).agg(F.array_sort(F.collect_list(order)).alias("ids"))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).join(few, keys)

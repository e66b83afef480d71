"""Annotation: by rules as native expressions, or by a caller's function in Arrow batches."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tagwright.functions.text import named, quoted
from tagwright.operators.responses import mark_failed
from tagwright.vocabulary import CONFIDENCE, NOT_MENTIONED, NOTES, VOCABULARY, response_fields

# (field, pattern, value) and, if wanted, lower-case words of which one is in every text that the pattern matches.
Rule = tuple[str, str, str] | tuple[str, str, str, tuple[str, ...]]

PIECE_ROWS = 256

# Wording that settles a driving label on its own. Patterns are for text in lower case.
DRIVING_RULES: list[Rule] = [
    ("maneuver_long", r"\b(slow|brake|decelerate|follow)\w*\b.*\blead\b|\b(distance|gap) (to|from) the lead\b", "lead_obstacle_following", ("lead",)),
    ("maneuver_long", r"\b(stop|slow)\w*\b.*\b(red (traffic )?light|stop sign|stop line)", "stop_for_static_constraints", ("red light", "red traffic light", "stop sign", "stop line")),
    ("maneuver_long", r"\b(yield|slow|stop)\w*\b.*\bpedestrians?\b", "yield", ("pedestrian",)),
    ("maneuver_long", r"\b(slow|adapt|reduce)\w*\b.*\b(curve|bump|ramp|roundabout|grade|hill)s?\b", "speed_adaptation", ("curve", "bump", "ramp", "roundabout", "grade", "hill")),
    ("maneuver_long", r"\bslow\w*\b.*\bgap\b.*\blane change\b", "gap_searching", ("lane change",)),
    ("maneuver_lat", r"\bnudge\b.*\b(within|inside)\b.*\blane\b", "in_lane_nudge", ("nudge",)),
    ("maneuver_lat", r"\bnudge\b.*\bover the (lane )?line\b", "out_of_lane_nudge", ("nudge",)),
    ("maneuver_lat", r"\bchange lanes?\b.*\bleft\b|\bleft lane change\b", "lane_change_left", ("change lane", "lane change")),
    ("maneuver_lat", r"\bchange lanes?\b.*\bright\b|\bright lane change\b", "lane_change_right", ("change lane", "lane change")),
    ("maneuver_lat", r"\bmerg\w*\b.*\b(highway|freeway|mainline)\b", "merge_split", ("merg",)),
    ("traffic_light", r"\bred (traffic )?light\b", "red", ("red light", "red traffic light")),
    ("traffic_light", r"\bgreen (traffic )?light\b", "green", ("green light", "green traffic light")),
    ("traffic_light", r"\byellow (traffic )?light\b", "yellow", ("yellow light", "yellow traffic light")),
    ("traffic_control", r"\bstop sign\b", "stop_sign", ("stop sign",)),
    ("traffic_control", r"\byield sign\b", "yield_sign", ("yield sign",)),
    ("traffic_control", r"\b(crosswalk|pedestrian crossing)\b", "pedestrian_crossing", ("crosswalk", "pedestrian crossing")),
    ("traffic_control", r"\bconstruction (warning )?sign\b", "construction_sign", ("construction sign", "construction warning sign")),
    ("odd_condition", r"\brain", "rain", ("rain",)),
    ("odd_condition", r"\bfog", "fog", ("fog",)),
    ("odd_condition", r"\bnight\b", "night", ("night",)),
    ("odd_condition", r"\bconstruction zone\b", "construction", ("construction zone",)),
    ("road_geometry", r"\bcurve", "curve", ("curve",)),
    ("road_geometry", r"\bbumps?\b", "speed_bump", ("bump",)),
    ("road_geometry", r"\bhills?\b", "grade", ("hill",)),
    ("lane_config", r"\blane (ends|is ending|ending)\b", "lane_end", ("lane end", "lane is ending")),
    ("lane_config", r"\blane (is )?merg", "lane_merge", ("lane merg", "lane is merg")),
    ("lane_config", r"\blane (is )?split", "lane_split", ("lane split", "lane is split")),
    ("routing_intent", r"\bneed\w* to turn left\b", "turn_left", ("to turn left",)),
    ("routing_intent", r"\bneed\w* to turn right\b", "turn_right", ("to turn right",)),
]


def label_by_rules(
    df: DataFrame, text_col: str, rules: Sequence[Rule], lower: bool = False
) -> DataFrame:
    """Add one array column per field with the values whose pattern occurs in the text.

    Values keep rule order without repeats; a field without a hit is ``['none']``. With ``lower`` the text
    is put in lower case first, once for all rules. A rule's words are looked for before its
    pattern: a plain search, which most texts end at.
    """
    text = named("__text")

    def hit(rule: Rule) -> str:
        words = " OR ".join(f"contains({text}, {quoted(w)})" for w in (rule[3] if len(rule) > 3 else ()))
        found = f"{text} RLIKE {quoted(rule[1])}"
        return f"CASE WHEN {f'({words}) AND {found}' if words else found} THEN {quoted(rule[2])} END"

    fields = dict.fromkeys(r[0] for r in rules)
    # The text column twice: the labels are all made from one lower-case copy.
    read = named(text_col)
    told = df.selectExpr("*", f"{f'lower({read})' if lower else read} AS {text}")
    hits = {
        f: f"array_distinct(array_compact(array({', '.join(hit(r) for r in rules if r[0] == f)})))" for f in fields
    }
    found = told.selectExpr("*", *[f"{e} AS {named('__' + f)}" for f, e in hits.items()])
    kept = [named(c) for c in df.columns if c not in fields]
    return found.selectExpr(
        *kept,
        *[f"IF(size({named('__' + f)}) > 0, {named('__' + f)}, array({quoted(NOT_MENTIONED)})) AS {named(f)}" for f in fields],
    )


def answered_rows(answer: Mapping | str, vocab: Mapping[str, Sequence[str]]) -> list[Mapping]:
    """The rows of one answer; raises if it has a key twice, a row is no object, or a field neither text nor null."""
    told = json.loads(answer, object_pairs_hook=_unique) if isinstance(answer, str) else answer
    rows = told.get("rows") or []
    for row in rows:
        for field in vocab:
            if not isinstance(row.get(field), str | None):
                raise TypeError(f"{field} is no text")
    return list(rows)


def _unique(pairs: list[tuple]) -> dict:
    found = dict(pairs)
    if len(found) < len(pairs):
        raise ValueError("a key is there twice")
    return found


def with_retries(
    call: Callable[[], list], attempts: int, sleep: Callable[[float], None]
) -> tuple[list, int, str | None]:
    """``(rows, attempts used, last error)``. Errors are followed by a pause of 2, 4, … seconds,
    except after the last attempt; an empty answer is tried again at once."""
    error = None
    for attempt in range(1, attempts + 1):
        try:
            rows = call()
            if rows:
                return rows, attempt, None
            error = "no rows"
        except Exception as failure:
            error = str(failure)
            if attempt < attempts:
                sleep(2**attempt)
    return [], attempts, error


def annotation_results(vocab: Mapping[str, Sequence[str]]) -> T.StructType:
    """The columns of an annotated row beside its keys."""
    return T.StructType(
        [
            *[T.StructField(f, T.StringType()) for f in response_fields(vocab)],
            T.StructField("attempts", T.IntegerType()),
            T.StructField("status", T.StringType()),
            T.StructField("error", T.StringType()),
        ]
    )


def annotation_values(found: Mapping, vocab: Mapping[str, Sequence[str]]) -> list[str | None]:
    """The fields of one answered row as text, confidence and notes last; empty fields are null."""
    values = [found.get(f) or None for f in vocab] + [found.get(CONFIDENCE), found.get(NOTES)]
    return [None if v is None else str(v) for v in values]


def _with_results(
    batch: pa.RecordBatch, keys: Sequence[str], picks: list[int], results: T.StructType, rows: list
) -> pa.RecordBatch:
    """The key columns of the picked input rows beside the result rows."""
    kept = batch.select(list(keys)).take(pa.array(picks, pa.int64()))
    found = [
        pa.array([r[i] for r in rows], to_arrow_type(f.dataType)) for i, f in enumerate(results)
    ]
    return pa.RecordBatch.from_arrays([*kept.columns, *found], names=[*keys, *results.names])


def _in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut small: few rows are Python objects at a time, and results flow out early."""
    for batch in batches:
        for start in range(0, batch.num_rows, PIECE_ROWS):
            yield batch.slice(start, PIECE_ROWS)


def _schema(df: DataFrame, keys: Sequence[str], results: T.StructType) -> T.StructType:
    return T.StructType([*[df.schema[k] for k in keys], *results])


def annotate(
    df: DataFrame,
    keys: Sequence[str],
    answer: Callable[[dict], Mapping | str] | None = None,
    vocab: dict[str, list[str]] = VOCABULARY,
    attempts: int = 3,
    partitions: int | None = None,
    sleep: Callable[[float], None] = time.sleep,
    concurrency: int = 1,
    client: Callable[[], Callable[[dict], Mapping | str]] | None = None,
    calls: int | None = None,
) -> DataFrame:
    """Ask ``answer`` for every row: ``(keys, fields…, attempts, status, error)``.

    ``answer`` takes the row as a dict and returns ``{"rows": [...]}`` or its
    JSON text. Instead, ``client`` makes it: it is called once in each task, so that connections need
    not be shipped. ``partitions`` bounds how many tasks call at once; rows are
    then dealt out evenly, whatever the keys. Each task has up to ``concurrency`` calls open, and
    returns rows in their order. A row that fails ``attempts`` times
    becomes one dead-letter row, so the batch goes on.

    ``calls`` is a true bound on open calls, instead of ``partitions``: a barrier stage of ``calls`` / ``concurrency`` tasks, of
    which Spark starts all or none, and never a second copy of one, so that the bound holds whatever else runs. It needs
    as many free cores, and a failure repeats the stage as a whole.

    A lost executor or a second use of the result calls again: write the result
    to a table before using it, and make ``answer`` safe to repeat per key.
    Fields are not validated here; see ``validate_rows``.
    """
    if (answer is None) == (client is None):
        raise ValueError("give either answer or client")
    results = annotation_results(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = client() if client else answer

        def one(row: dict) -> tuple[list, int, str | None]:
            return with_retries(lambda: answered_rows(ask(row), vocab), attempts, sleep)

        with ThreadPoolExecutor(concurrency) as pool:
            each = map if concurrency == 1 else pool.map
            for batch in _in_pieces(batches):
                picks, out = [], []
                for i, (rows, used, error) in enumerate(each(one, batch.to_pylist())):
                    state = [used, "ok" if rows else "failed", error]
                    for found in rows or [{}]:
                        picks.append(i)
                        out.append([*annotation_values(found, vocab), *state])
                yield _with_results(batch, keys, picks, results, out)

    if calls is not None:
        if partitions is not None or calls % concurrency:
            raise ValueError("give calls, a multiple of concurrency, or partitions")
        partitions = calls // concurrency
    dealt = df if partitions is None else df.repartition(partitions)
    told = dealt.mapInArrow(run, _schema(df, keys, results), barrier=calls is not None)
    return mark_failed(told, F.col("status") == "failed", attempts, vocab)


def predict(
    df: DataFrame,
    keys: Sequence[str],
    predictor: Callable[[dict], Mapping],
    results: str,
    partitions: int | None = None,
) -> DataFrame:
    """Call ``predictor`` once per row: ``(keys, results…, status)``.

    ``results`` is a DDL list of result columns. Status is ``Success``, or
    ``Error: …`` with NULL results; one bad row never fails the batch.
    """
    wanted = T.StructType.fromDDL(results)
    schema = T.StructType([*wanted, T.StructField("status", T.StringType())])
    kinds = {f.name: to_arrow_type(f.dataType) for f in wanted}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _in_pieces(batches):
            out = []
            for row in batch.to_pylist():
                try:
                    got = predictor(row)
                    values = [pa.scalar(got.get(c), kind).as_py() for c, kind in kinds.items()]
                    out.append([*values, "Success"])
                except Exception as failure:
                    out.append([*[None] * len(kinds), f"Error: {failure}"])
            yield _with_results(batch, keys, list(range(len(out))), schema, out)

    dealt = df if partitions is None else df.repartition(partitions)
    return dealt.mapInArrow(run, _schema(df, keys, schema))

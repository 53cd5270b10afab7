"""Episode tables derived from the given test tables, once with Spark and once as SQL for the oracle.

FE  frames from ``events`` (holes and time inversions), FL  frames from ``lineitem`` (one episode per supplier),
FS  frames from ``lineitem`` (six episodes of uneven size hold the whole table),
FC  frames from ``conversations`` (clean), EM  vectors from ``embeddings``, TK  task texts, EP  episode metadata of FE,
VF  video files of EP.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.config import (
    AnnotationConfig,
    AnnotationRule,
    FrameColumns,
    ManifestConfig,
    SyncConfig,
    WindowSpec,
)
from strideframe.operators.ordering import with_group_position
from strideframe.sources.small import literal_table

CREATED_AT = "2026-01-01T00:00:00+00:00"

TASKS = [
    (0, "Click the item."),
    (1, "Report the error."),
    (2, "Buy the item."),
    (3, "Create an account."),
    (4, "View the item."),
]
EVENT_TASKS = {"click": 0, "error": 1, "purchase": 2, "signup": 3, "view": 4}
LINE_TASKS = {"AF": 0, "AO": 1, "NF": 2, "NO": 3, "RF": 4, "RO": 5}
ROLE_TASKS = {"system": 0, "user": 1, "assistant": 2}

RULES = (
    AnnotationRule("View the item.", ("Look at the item.", "Open the item page."), task_label="browse"),
    AnnotationRule("Buy the item.", ("Order the item.",), task_label="shop", object_label="item"),
)

RAW_COLUMNS = FrameColumns()
FE_SYNC = SyncConfig(
    columns=FrameColumns(instruction="task.instructions"),
    stride=5,
    window=WindowSpec(-4, 0, 1, 4),
    max_gap_seconds=172800.0,
)
FL_SYNC = SyncConfig(stride=30, window=WindowSpec(-10, 0, 1, 10), max_gap_seconds=1209600.0)
ANNOTATE = AnnotationConfig(
    version="ann_v1",
    policy="source_and_rules",
    created_at_utc=CREATED_AT,
    task_label="shopping",
    object_label="item",
    scene_label="shop",
    rules=RULES,
    require_status="ok",
)
MANIFEST = ManifestConfig(
    require_status="ok",
    annotation_version="ann_v1",
    join_columns=("episode_id", "source_instruction_id"),
)
EPISODE_MANIFEST = ManifestConfig(require_status="ok", annotation_version="ann_v1", join_columns=("episode_id",))
ANNOTATION_SNAPSHOT = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(name: str):
    return F.unix_micros(F.col(name).cast("timestamp"))


def _coded(value, codes: dict[str, int]):
    mapping = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return F.element_at(mapping, value).cast("long")


def event_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", "event_type", "value", "props", F.date_trunc("hour", "ts").alias("hour")
    )
    numbered = with_group_position(events, ["user_id"], "hour", ["ts", "event_id"], "frame_index")
    seconds = micros("ts") / F.lit(1e6)
    inverted = F.when(F.col("event_id") % 101 == 5, seconds - 864000.0).otherwise(seconds)
    # every 13th number is left out, so episodes have holes and no event is lost
    spaced = F.col("frame_index") + F.floor(F.col("frame_index") / 12)
    return numbered.select(
        F.col("user_id").alias("episode_index"),
        spaced.alias("frame_index"),
        inverted.alias("timestamp"),
        _coded(F.col("event_type"), EVENT_TASKS).alias("task_index"),
        F.array(F.col("value"), F.get_json_object("props", "$.k").cast("double")).alias("observation.state"),
        F.array(F.col("value")).alias("action"),
        F.lit(None).cast("string").alias("task.instructions"),
    )


def line_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
        _coded(F.concat("l_returnflag", "l_linestatus"), LINE_TASKS).alias("task_index"),
        F.date_trunc("quarter", "l_shipdate").alias("quarter"),
    )
    # a supplier has about one line a day, so pieces of a day would be as many as the lines
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
    return with_group_position(lines, ["l_suppkey"], "quarter", order, "frame_index").select(
        F.col("l_suppkey").alias("episode_index"),
        "frame_index",
        (micros("l_shipdate") / F.lit(1e6)).alias("timestamp"),
        "task_index",
    )


def skewed_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_suppkey"]
    kind = _coded(F.concat("l_returnflag", "l_linestatus"), LINE_TASKS)
    lines = table(spark, sf_dir, "lineitem").select("l_shipdate", *order, kind.alias("episode_index"))
    return with_group_position(lines, ["episode_index"], "l_shipdate", order, "frame_index").select(
        "episode_index",
        "frame_index",
        (micros("l_shipdate") / F.lit(1e6)).alias("timestamp"),
        (F.col("l_linenumber") % 5).cast("long").alias("task_index"),
    )


def turn_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("episode_index"),
        F.col("turn").alias("frame_index"),
        F.col("turn").cast("double").alias("timestamp"),
        _coded(F.col("role"), ROLE_TASKS).alias("task_index"),
        F.col("text").alias("task.instructions"),
    )


#: conversations that get a fault, by conv_id modulo 50: a turn left out, a turn twice, a step back in time, a wrong vector
LACKS_TURN, HAS_TURN_TWICE, STEPS_BACK, WRONG_VECTOR = 7, 9, 11, 13
#: what the description of the faulty snapshot says
FAULTY_INFO = {
    "codebase_version": "v2.1", "chunks_size": 10, "video_path": "videos/{video_key}/chunk-{episode_chunk:03d}.mp4",
    "features": {
        "observation.state": {"dtype": "float64", "shape": [1]}, "action": {"dtype": "float64", "shape": [1]},
        "observation.images.front": {"dtype": "video", "shape": [1, 1, 3]},
    },
}


def faulty_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns as frames with vectors, with a fault of every kind in some conversations."""
    turns = turn_frames(spark, sf_dir).drop("task.instructions")
    case = F.col("episode_index") % 50
    twice = turns.where((case == HAS_TURN_TWICE) & (F.col("frame_index") == 0))
    back = (case == STEPS_BACK) & (F.col("frame_index") == 1)
    wrong = (case == WRONG_VECTOR) & (F.col("frame_index") == 0)
    value = F.col("frame_index").cast("double")
    return (
        turns.where(~((case == LACKS_TURN) & (F.col("frame_index") == 1))).union(twice)
        .withColumn("timestamp", F.when(back, F.lit(-5.0)).otherwise(F.col("timestamp")))
        .withColumn("action", F.array(value))
        .withColumn("observation.state", F.when(wrong, F.array(value, value)).otherwise(F.array(value)))
    )


FAULTY_SQL = f"""
ff as (
  select episode_index, frame_index, case when episode_index % 50 = {STEPS_BACK} and frame_index = 1 then -5.0 else "timestamp" end
      as "timestamp", task_index, case when episode_index % 50 = {WRONG_VECTOR} and frame_index = 0 then 2 else 1 end as vector_length
  from (select * from fc where not (episode_index % 50 = {LACKS_TURN} and frame_index = 1)
        union all select * from fc where episode_index % 50 = {HAS_TURN_TWICE} and frame_index = 0)
)"""


def task_table(spark: SparkSession) -> DataFrame:
    return literal_table(spark, TASKS, "task_index long, task string")


def episode_metadata(frames: DataFrame) -> DataFrame:
    """Lengths (wrong for every seventh episode) and numbered video shards of two cameras."""
    episode = F.col("episode_index")
    lengths = frames.groupBy("episode_index").agg(F.count(F.lit(1)).alias("n"))
    chunk, file = F.floor(episode / 10).cast("long"), episode % 10
    return lengths.select(
        "episode_index",
        F.when(episode % 7 == 3, F.col("n") + 1).otherwise(F.col("n")).alias("length"),
        chunk.alias("videos/cam_a/chunk_index"),
        file.alias("videos/cam_a/file_index"),
        chunk.alias("videos/cam_b/chunk_index"),
        F.when(episode % 5 != 0, file).alias("videos/cam_b/file_index"),
    )


def video_files(episodes: DataFrame) -> DataFrame:
    """The shard files of the metadata, except those of every eleventh episode."""
    cameras = [
        F.when(
            F.col(f"`videos/{key}/file_index`").isNotNull(),
            F.format_string(
                f"videos/{key}/chunk-%03d/file-%03d.mp4",
                F.col(f"`videos/{key}/chunk_index`"),
                F.col(f"`videos/{key}/file_index`"),
            ),
        )
        for key in ("cam_a", "cam_b")
    ]
    present = episodes.where(F.col("episode_index") % 11 != 4)
    paths = present.select("episode_index", F.explode(F.array(*cameras)).alias("path"))
    return paths.where(F.col("path").isNotNull()).select(
        "path", (F.col("episode_index") + 1000).cast("long").alias("length")
    )


# --- the same views for the oracle ---------------------------------------------------------------------------------

FE_SQL = """
fe as (
  select user_id as episode_index, frame_index + frame_index // 12 as frame_index,
         case when event_id % 101 = 5 then epoch_us(ts) / 1e6 - 864000.0 else epoch_us(ts) / 1e6 end as "timestamp",
         cast(case event_type when 'click' then 0 when 'error' then 1 when 'purchase' then 2 when 'signup' then 3
              when 'view' then 4 end as bigint) as task_index,
         value, cast(regexp_extract(props, '"k": *(-?[0-9]+)', 1) as double) as k
  from (select *, row_number() over (partition by user_id order by ts, event_id) - 1 as frame_index from events)
)"""

FL_SQL = """
fl as (
  select l_suppkey as episode_index,
         row_number() over (partition by l_suppkey order by l_shipdate, l_orderkey, l_linenumber, l_partkey,
                            l_quantity, l_extendedprice) - 1 as frame_index,
         epoch_us(l_shipdate) / 1e6 as "timestamp",
         cast(case l_returnflag || l_linestatus when 'AF' then 0 when 'AO' then 1 when 'NF' then 2 when 'NO' then 3
              when 'RF' then 4 when 'RO' then 5 end as bigint) as task_index
  from lineitem
)"""

FS_SQL = """
fs as (
  select cast(case l_returnflag || l_linestatus when 'AF' then 0 when 'AO' then 1 when 'NF' then 2 when 'NO' then 3
              when 'RF' then 4 when 'RO' then 5 end as bigint) as episode_index,
         row_number() over (partition by l_returnflag, l_linestatus order by l_shipdate, l_orderkey, l_linenumber,
                            l_partkey, l_quantity, l_extendedprice, l_suppkey) - 1 as frame_index,
         epoch_us(l_shipdate) / 1e6 as "timestamp", cast(l_linenumber % 5 as bigint) as task_index
  from lineitem
)"""

FC_SQL = """
fc as (
  select conv_id as episode_index, turn as frame_index, cast(turn as double) as "timestamp",
         cast(case role when 'system' then 0 when 'user' then 1 when 'assistant' then 2 end as bigint) as task_index,
         text as instruction
  from conversations
)"""

TK_SQL = """
tk(task_index, task) as (
  values (0, 'Click the item.'), (1, 'Report the error.'), (2, 'Buy the item.'), (3, 'Create an account.'),
         (4, 'View the item.')
)"""

RULES_SQL = """
rules(match_text, text, annotation_type, task_label, object_label, scene_label, is_active) as (
  values ('View the item.', 'Look at the item.', 'paraphrase', 'browse', cast(null as varchar), cast(null as varchar), true),
         ('View the item.', 'Open the item page.', 'paraphrase', 'browse', null, null, true),
         ('Buy the item.', 'Order the item.', 'paraphrase', 'shop', 'item', null, true)
)"""

EP_SQL = """
ep as (
  select episode_index, case when episode_index % 7 = 3 then n + 1 else n end as length,
         episode_index // 10 as a_chunk, episode_index % 10 as a_file, episode_index // 10 as b_chunk,
         case when episode_index % 5 <> 0 then episode_index % 10 end as b_file
  from (select episode_index, count(*) as n from fe group by episode_index)
),
refs as (
  select episode_index, 'cam_a' as video_key,
         format('videos/cam_a/chunk-{:03d}/file-{:03d}.mp4', a_chunk, a_file) as path from ep
  union all
  select episode_index, 'cam_b',
         format('videos/cam_b/chunk-{:03d}/file-{:03d}.mp4', b_chunk, b_file) from ep where b_file is not null
),
vf as (select path, 1000 + episode_index as length from refs where episode_index % 11 <> 4)"""


def synced_sql(source: str, stride: int, window: WindowSpec, max_gap: float, text: str) -> str:
    """CTEs ``anchors``, ``spans`` (window rows with gaps), ``stats_o``, ``stats_a`` and ``synced``; a range join."""
    w = window

    def stats(name: str, role: str, prefix: str) -> str:
        return f"""
{name} as (
  select sample_id, count(frame_index) as {prefix}_rows, min(frame_index) as {prefix}_actual_start_frame,
         max(frame_index) as {prefix}_actual_end_frame, min(ts) as {prefix}_start_timestamp,
         max(ts) as {prefix}_end_timestamp, max(ts) - min(ts) as {prefix}_duration_seconds,
         max(abs(gap)) as {prefix}_max_timestamp_gap_seconds, min(gap) as {prefix}_min_timestamp_gap_seconds
  from spans where role = '{role}' group by sample_id
)"""

    return f"""
anchors as (
  select concat_ws('_', 'sample', f.episode_index, 'task_' || f.task_index, f.frame_index) as sample_id,
         cast(f.episode_index as varchar) as episode_id, f.episode_index, f.frame_index as anchor_frame,
         f."timestamp" as anchor_timestamp, cast(null as bigint) as anchor_sensor_timestamp,
         'task_' || f.task_index as instruction_id, {text} as instruction_text,
         f.frame_index + ({w.observation_start_offset}) as observation_start_frame,
         f.frame_index + ({w.observation_end_offset}) as observation_end_frame,
         f.frame_index + ({w.action_start_offset}) as action_start_frame,
         f.frame_index + ({w.action_end_offset}) as action_end_frame
  from {source} f left join tk t on f.task_index = t.task_index
  where f.frame_index % {stride} = 0 and f.frame_index + ({w.observation_start_offset}) >= 0
),
spans as (
  select *, ts - lag(ts) over (partition by sample_id, role order by frame_index) as gap
  from (
    select a.sample_id, 'observation' as role, f.frame_index, f."timestamp" as ts
    from anchors a join {source} f on f.episode_index = a.episode_index
      and f.frame_index between a.observation_start_frame and a.observation_end_frame
    union all
    select a.sample_id, 'action', f.frame_index, f."timestamp"
    from anchors a join {source} f on f.episode_index = a.episode_index
      and f.frame_index between a.action_start_frame and a.action_end_frame
  )
),{stats("stats_o", "observation", "observation")},{stats("stats_a", "action", "action")},
measured as (
  select a.* exclude (episode_index),
         observation_end_frame - observation_start_frame + 1 as expected_observation_rows,
         action_end_frame - action_start_frame + 1 as expected_action_rows,
         'raw.frames' as source_frames_table, cast(null as bigint) as source_frames_snapshot_id,
         'frame_window_timestamp_validation_v1' as sync_rule,
         o.* exclude (sample_id) replace (coalesce(observation_rows, 0) as observation_rows),
         c.* exclude (sample_id) replace (coalesce(action_rows, 0) as action_rows),
         observation_end_frame - observation_start_frame + 1 - coalesce(observation_rows, 0)
           as observation_missing_rows,
         action_end_frame - action_start_frame + 1 - coalesce(action_rows, 0) as action_missing_rows,
         greatest(coalesce(observation_max_timestamp_gap_seconds, 0.0), coalesce(action_max_timestamp_gap_seconds, 0.0))
           as max_timestamp_gap_seconds,
         least(coalesce(observation_min_timestamp_gap_seconds, 0.0), coalesce(action_min_timestamp_gap_seconds, 0.0))
           as min_timestamp_gap_seconds
  from anchors a left join stats_o o using (sample_id) left join stats_a c using (sample_id)
),
synced as (
  select *,
         case when observation_missing_rows > 0 or action_missing_rows > 0 then 'missing_window_rows'
              when min_timestamp_gap_seconds < 0 then 'non_monotonic_timestamp'
              when max_timestamp_gap_seconds > {max_gap} then 'timestamp_gap_exceeded'
              else 'ok' end as sync_status,
         cast({max_gap} as double) as max_allowed_timestamp_gap_seconds,
         observation_missing_rows = 0 and action_missing_rows = 0 as is_window_complete,
         min_timestamp_gap_seconds >= 0 as is_timestamp_monotonic,
         max_timestamp_gap_seconds <= {max_gap} as is_gap_within_threshold
  from measured
)"""


FE_TEXT = "coalesce(t.task, 'task_' || f.task_index)"
FE_SYNCED_SQL = ",".join([FE_SQL, TK_SQL, synced_sql("fe", 5, FE_SYNC.window, 172800.0, FE_TEXT)])
FS_SYNCED_SQL = ",".join([FS_SQL, TK_SQL, synced_sql("fs", 30, FL_SYNC.window, 1209600.0, FE_TEXT)])
FL_SYNCED_SQL = ",".join([FL_SQL, TK_SQL, synced_sql("fl", 30, FL_SYNC.window, 1209600.0, FE_TEXT)])

ANNOTATIONS_SQL = f"""{RULES_SQL},
source_ann as (
  select distinct episode_id, instruction_id as source_instruction_id, instruction_text as source_instruction_text,
         instruction_text as text, 'source_task' as annotation_type, 'shopping' as task_label, 'item' as object_label,
         'shop' as scene_label, true as is_active
  from synced where sync_status = 'ok' and instruction_text is not null
),
rule_ann as (
  select s.episode_id, s.source_instruction_id, s.source_instruction_text, r.text, r.annotation_type, r.task_label,
         r.object_label, r.scene_label, r.is_active
  from source_ann s join rules r on s.source_instruction_text = r.match_text
),
ann as (
  select 'inst_' || substr(sha256(concat_ws('||', episode_id, source_instruction_id, text, annotation_type, 'ann_v1',
           'source_and_rules')), 1, 16) as instruction_id,
         episode_id, source_instruction_id, source_instruction_text, text, annotation_type,
         'ann_v1' as annotation_version, 'source_and_rules' as annotation_policy, 'en' as language,
         task_label, object_label, scene_label, 'annotation_builder' as created_by,
         '{CREATED_AT}' as created_at_utc, is_active
  from (select * from source_ann union all select * from rule_ann)
)"""

FE_ANN_SQL = f"{FE_SYNCED_SQL},{ANNOTATIONS_SQL}"


def manifest_sql(on_instruction: bool) -> str:
    more = "and s.instruction_id = a.source_instruction_id" if on_instruction else ""
    return f"""
manifest as (
  select concat_ws('_', 'sample', s.episode_id, a.instruction_id, s.anchor_frame) as sample_id,
         s.sample_id as source_sample_id, s.episode_id, s.instruction_id as source_instruction_id,
         s.instruction_text as source_instruction_text, a.instruction_id, a.text as instruction_text,
         a.annotation_type, a.annotation_version, a.annotation_policy, a.language as annotation_language,
         a.task_label, a.object_label, a.scene_label, 'annotations.instructions' as annotation_table,
         cast({ANNOTATION_SNAPSHOT} as bigint) as annotation_snapshot_id, s.anchor_frame,
         s.observation_start_frame, s.observation_end_frame, s.action_start_frame, s.action_end_frame,
         s.anchor_timestamp, s.observation_start_timestamp, s.observation_end_timestamp, s.action_start_timestamp,
         s.action_end_timestamp, s.observation_rows, s.action_rows, s.max_timestamp_gap_seconds, s.sync_status,
         s.sync_rule, s.source_frames_table, s.source_frames_snapshot_id
  from synced s join ann a on s.episode_id = a.episode_id {more}
  where s.sync_status = 'ok' and a.is_active and a.annotation_version = 'ann_v1'
)"""


FE_MANIFEST_SQL = f"{FE_ANN_SQL},{manifest_sql(True)}"

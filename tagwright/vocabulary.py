"""The built-in driving vocabulary, and response schemas made from any vocabulary.

A vocabulary is ``dict[field, list[value]]``. It is small by nature (it has to
fit in a prompt), so it lives on the driver and enters plans as literals.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---- Fixed values: field vocabularies, groups and definitions ---------------

VOCABULARY: dict[str, list[str]] = {
    "maneuver_lat": [
        "lane_keeping", "merge_split", "out_of_lane_nudge", "in_lane_nudge",
        "lane_change_left", "lane_change_right", "pull_over", "turn_left",
        "turn_right", "u_turn", "lateral_maneuver_abort", "none",
    ],
    "maneuver_long": [
        "set_speed_tracking", "lead_obstacle_following", "speed_adaptation", "gap_searching",
        "acceleration_for_passing", "yield", "stop_for_static_constraints", "none",
    ],
    "traffic_light": ["green", "yellow", "red", "flashing", "arrow_green", "arrow_red", "none"],
    "traffic_control": [
        "stop_sign", "yield_sign", "pedestrian_crossing", "school_zone", "rail_crossing",
        "speed_limit", "no_entry", "one_way", "right_of_way", "construction_sign",
        "lane_control_sign", "none",
    ],
    "road_geometry": [
        "straight", "curve", "grade", "speed_bump", "narrowing", "roundabout", "ramp",
        "intersection", "none",
    ],
    "lane_config": [
        "lane_merge", "lane_split", "lane_exit", "lane_end", "bike_lane", "shoulder", "none",
    ],
    "odd_condition": [
        "rain", "snow", "fog", "night", "construction", "emergency_vehicle", "school_bus", "none",
    ],
    "routing_intent": [
        "go_straight", "turn_left", "turn_right", "lane_change_needed", "merge_needed",
        "exit_needed", "none",
    ],
    "agent_type": [
        "car", "truck", "bus", "motorcycle", "bicycle", "pedestrian", "scooter",
        "emergency_vehicle", "vehicle", "none",
    ],
    "relative_position": [
        "in_path_ahead", "in_path_behind", "left_adjacent", "right_adjacent", "oncoming",
        "crossing_path", "roadside", "none",
    ],
    "lane_relation": [
        "same_lane", "left_lane", "right_lane", "oncoming_lane", "cross_traffic", "off_road",
        "none",
    ],
    "agent_behavior": [
        "stationary", "decelerating", "accelerating", "constant_speed", "crossing_path",
        "cutting_in", "lane_changing", "weaving", "backing_out", "encroaching",
        "yielding_to_ego", "blocking_lane", "unknown", "none",
    ],
}

GROUPS: dict[str, list[str]] = {
    "maneuver": ["maneuver_lat", "maneuver_long"],
    "environment": [
        "traffic_light", "traffic_control", "road_geometry", "lane_config", "odd_condition",
        "routing_intent",
    ],
    "agent": ["agent_type", "relative_position", "lane_relation", "agent_behavior"],
}

VALUE_DEFINITIONS: dict[str, dict[str, str]] = {
    "maneuver_long": {
        "set_speed_tracking": "Maintain or reach a target speed when unconstrained; excludes follow/yield/stop logic.",
        "lead_obstacle_following": "Maintain a safe time gap to the lead entity (closest in-path entity moves in the same traffic flow); excludes geometry-based slowing, gap-matching, and yielding to non-lead entity.",
        "speed_adaptation": "Adjust speed for roadway features (curves, grades, bumps, ramps, roundabouts, turns); independent of a lead.",
        "gap_searching": "Adjust speed to match the target stream or create a usable gap to support a planned lateral maneuver.",
        "acceleration_for_passing": "Increase speed to pass a slower lead with an associated lateral plan.",
        "yield": "Slow/stop to concede priority to specific agents (pedestrians, cross-traffic, emergency vehicles, cut-ins).",
        "stop_for_static_constraints": "Decelerate to and hold at control points (stop/yield lines, red light, school bus/rail rules).",
    },
    "maneuver_lat": {
        "lane_keeping": "Maintain position within lane boundaries; minor in-lane offsets allowed; never cross lane lines.",
        "merge_split": "Transition between facilities (e.g., on-ramp to mainline, weave segments); not a same-road lane change.",
        "out_of_lane_nudge": "Brief, intentional lane-line crossing to increase clearance around a blockage/hazard; return to original lane.",
        "in_lane_nudge": "Temporary offset within the lane (no line crossing) to increase clearance around a blockage/hazard.",
        "lane_change_left": "Full adjacent-lane transition with gap negotiation to the left.",
        "lane_change_right": "Full adjacent-lane transition with gap negotiation to the right.",
        "pull_over": "Move toward edge/shoulder or a designated stop area (pickup, emergency stop, parking approach).",
        "turn_left": "Planned path onto a different road segment with a significant heading change to the left.",
        "turn_right": "Planned path onto a different road segment with a significant heading change to the right.",
        "u_turn": "Planned path reversing the direction of travel.",
        "lateral_maneuver_abort": "Cancel an ongoing lateral maneuver (nudge, lane change, merge/split, pull-over) and re-center when safe.",
    },
}

FIELD_DEFINITIONS: dict[str, str] = {
    "traffic_light": "Traffic signal state including current color (R/Y/G), arrow state, and visibility/occlusion.",
    "traffic_control": "Regulatory signage and infrastructure: stop/yield signs, pedestrian crossings, school zones, rail crossings, speed limits, lane control signs, construction signs.",
    "road_geometry": "Roadway geometric features: curvature/grade, speed bumps, narrowing, roundabouts, ramps, intersections.",
    "lane_config": "Lane configuration: lane count changes, merges, splits, exits, lane ends, bike lanes, shoulders.",
    "odd_condition": "Operational Design Domain constraints: weather/visibility (rain, snow, fog), time of day (night), construction zones, presence of emergency vehicles or school buses.",
    "routing_intent": "Ego vehicle's navigational goal: target lane/turn direction, near-term split/merge requirement.",
    "agent_type": "Type of other road agent: vehicle (car, truck, bus, motorcycle), vulnerable road user (pedestrian, cyclist, scooter), or emergency vehicle.",
    "relative_position": "Spatial position of the agent relative to the ego vehicle: in-path ahead/behind, adjacent left/right, oncoming, crossing path, or roadside.",
    "lane_relation": "Lane relationship of the agent relative to the ego vehicle: same lane, adjacent lanes, oncoming lane, cross traffic, or off-road.",
    "agent_behavior": "Observable motion behavior of the agent: stationary, decelerating, accelerating, constant speed, crossing path, cutting in, lane changing, weaving, backing out, encroaching into ego's lane, yielding to ego, or blocking the lane.",
}

NOT_MENTIONED = "none"
FAILED = "PARSE_ERROR"
CONFIDENCE_LEVELS = ["high", "medium", "low"]

# ---- end of fixed values ----------------------------------------------------

CONFIDENCE, NOTES = "confidence", "confidence_notes"
TOOL_NAME = "submit_ontology_parse"


def response_fields(vocab: dict[str, list[str]] = VOCABULARY) -> list[str]:
    """Columns of one answered row: the vocabulary fields, then confidence and notes."""
    return [*vocab, CONFIDENCE, NOTES]


def vocabulary_table(
    spark: SparkSession,
    vocab: dict[str, list[str]] = VOCABULARY,
    groups: dict[str, list[str]] = GROUPS,
    definitions: dict[str, dict[str, str]] = VALUE_DEFINITIONS,
) -> DataFrame:
    """The vocabulary as a dimension table, one row per (field, value)."""
    group_of = {field: group for group, fields in groups.items() for field in fields}
    rows = [
        (group_of.get(field), field, position, value, definitions.get(field, {}).get(value))
        for field, values in vocab.items()
        for position, value in enumerate(values)
    ]
    return spark.createDataFrame(
        rows, "group string, field string, position int, value string, definition string"
    )


def field_table(
    spark: SparkSession,
    definitions: dict[str, str] = FIELD_DEFINITIONS,
    groups: dict[str, list[str]] = GROUPS,
) -> DataFrame:
    """The defined fields as a dimension table, one row per field."""
    group_of = {field: group for group, fields in groups.items() for field in fields}
    rows = [
        (group_of.get(field), position, field, text)
        for position, (field, text) in enumerate(definitions.items())
    ]
    return spark.createDataFrame(rows, "group string, position int, field string, definition string")


def response_type(vocab: dict[str, list[str]] = VOCABULARY) -> T.StructType:
    """Spark type of a whole answer: ``rows ARRAY<STRUCT<all response fields STRING>>``."""
    row = T.StructType([T.StructField(f, T.StringType()) for f in response_fields(vocab)])
    return T.StructType([T.StructField("rows", T.ArrayType(row))])


def response_json_schema(vocab: dict[str, list[str]] = VOCABULARY) -> str:
    """JSON Schema text that constrains a service's answer to ``response_type``."""

    def text(description: str, **more) -> dict:
        return {"type": "string", **more, "description": description}

    def closed(properties: dict) -> dict:
        return {
            "type": "object",
            "properties": properties,
            "required": list(properties),
            "additionalProperties": False,
        }

    # Description texts of the response schema.
    per_field = "Comma-separated values from: {}. Use 'none' if not applicable."
    on_confidence = "Parsing confidence level."
    on_notes = "Explanation for medium/low confidence. Empty string if high."
    on_rows = (
        "One row per causal agent. If no agent is involved, "
        "return one row with agent fields set to 'none'."
    )

    row = {field: text(per_field.format(", ".join(values))) for field, values in vocab.items()}
    row[CONFIDENCE] = text(on_confidence, enum=CONFIDENCE_LEVELS)
    row[NOTES] = text(on_notes)
    rows = {"type": "array", "items": closed(row), "minItems": 1, "description": on_rows}
    return json.dumps(closed({"rows": rows}))

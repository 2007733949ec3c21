"""Reusable table operators: rows, joins, picks per key, aggregates, unions, data-quality reports."""
from rollbook.operators.aggregates import (duplicates, max_level, multi_flag_keys, pivot_fields,
                                           weekly_minutes)
from rollbook.operators.joins import (anti, anti_null_aware, apply_negations, cancelled_by, delete_not_in,
                                      eav_columns, eav_lookup, enrich, join_blank_safe, mark, propagate_flag,
                                      remove_matching, right_master, semi, single_responsible,
                                      update_from)
from rollbook.operators.picks import dedupe_preferred, latest, preferred, resolve_ties
from rollbook.operators.quality import dq_duplicates, dq_mismatch, dq_missing, dq_rule
from rollbook.operators.rows import (active_as_of, conform, distinct_of, expired_as_of, overage, override,
                                     tag)
from rollbook.operators.sets import merge_sources, union_distinct, with_literal_row

__all__ = ["active_as_of", "anti", "anti_null_aware", "apply_negations", "cancelled_by", "conform",
           "dedupe_preferred", "delete_not_in", "distinct_of", "dq_duplicates", "dq_mismatch", "dq_missing", "dq_rule",
           "duplicates", "eav_columns", "eav_lookup", "enrich", "expired_as_of", "join_blank_safe", "latest", "mark",
           "max_level", "merge_sources", "multi_flag_keys", "overage", "override", "pivot_fields",
           "preferred", "propagate_flag", "remove_matching", "resolve_ties", "right_master", "semi",
           "single_responsible", "tag", "union_distinct", "update_from", "weekly_minutes",
           "with_literal_row"]

"""DataFrame → DataFrame operators."""
from wardline.operators.columns import (AGE_TERMS, COVID_TERMS, GENDER_TERMS, drop_columns, match_columns)
from wardline.operators.fuzzy import dictionary_rounds, resolve_names, similar_pairs
from wardline.operators.reshape import melt_onehot, unpivot_values
from wardline.operators.resolve import (AnyMatch, Classes, Presence, Single, ValueEquals, classes,
                                        conflict_report, entity_aggregates, entity_index, entity_spine,
                                        gather_values, multi_values, single, tri_state)
from wardline.operators.route import not_a_number, route_rows, table_checks
from wardline.operators.user_aggregate import UserAggregate, aggregate_by
from wardline.operators.validate import (assert_none, assert_parents, duplicate_keys, guard_rows, invalid_choices,
                                         missing_parents, missing_required, unreadable_numbers)

__all__ = ["AGE_TERMS", "COVID_TERMS", "GENDER_TERMS", "drop_columns", "match_columns",
           "dictionary_rounds", "resolve_names", "similar_pairs", "melt_onehot",
           "unpivot_values", "AnyMatch", "Classes", "Presence", "Single", "ValueEquals", "classes",
           "conflict_report", "entity_aggregates", "entity_index", "entity_spine", "gather_values",
           "multi_values", "single", "tri_state", "not_a_number", "route_rows", "table_checks", "UserAggregate", "aggregate_by", "assert_none", "assert_parents", "duplicate_keys", "guard_rows",
           "invalid_choices", "missing_parents", "missing_required", "unreadable_numbers"]

"""Scalar Column builders."""
from wardline.functions.datetime import join_datetime, render_date, with_parsed_datetime
from wardline.functions.labels import (NULL_TOKENS, canonical_id, contains_ci, label_map,
                                       normalise_gender, null_tokens, number, regex_any, value_key)
from wardline.functions.text import (clean_label, java_quote, ref_range, similarity,
                                     split_literal, within_edit_distance)

__all__ = ["with_parsed_datetime", "join_datetime", "render_date", "NULL_TOKENS", "canonical_id",
           "contains_ci", "label_map", "normalise_gender", "null_tokens", "number", "regex_any", "value_key",
           "clean_label", "java_quote", "ref_range", "similarity", "split_literal",
           "within_edit_distance"]

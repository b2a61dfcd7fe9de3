from tallyboard.functions.numeric import nan_to_null, np_round, required
from tallyboard.functions.predicates import above, all_equal, all_null_safe_equal, differs, not_in
from tallyboard.functions.text import rank_text, season_label, strip_marker

__all__ = ["above", "all_equal", "all_null_safe_equal", "differs", "nan_to_null", "not_in", "np_round", "rank_text",
           "required", "season_label", "strip_marker"]

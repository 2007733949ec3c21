"""Column expressions shared by the operators and plans."""
from rollbook.functions.dates import (as_date, as_moment, midnight, moment, order_date, shift_days,
                                      text_us, year_diff, years_before)
from rollbook.functions.flags import (any_flag, band, clamp_min, fill_blank, is_false, is_yes, label,
                                      recode, when_flag, yes_no)
from rollbook.functions.numbers import dec, safe_div, to_scale, trunc_int
from rollbook.functions.ordering import precedes
from rollbook.functions.text import (coded, col, equals, fold, is_blank, like_ci, none_of, norm, not_blank,
                                     one_of, same)

__all__ = ["any_flag", "as_date", "as_moment", "band", "clamp_min", "coded", "col", "dec", "equals", "fill_blank",
           "fold", "is_blank", "is_false", "is_yes", "label", "like_ci", "midnight", "moment", "none_of",
           "norm", "not_blank", "one_of", "order_date", "precedes", "recode", "safe_div", "same",
           "shift_days", "text_us", "to_scale", "trunc_int", "when_flag", "year_diff", "years_before", "yes_no"]

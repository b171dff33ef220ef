"""Format predicates of the validation rules.

All return true/false, never null: a missing value never matches.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that decide which records are in error.
SPECIAL_CHARACTERS = r"""[`~!@#$%^&*()+=|{}':;,\[\].<>/?￥…—【】‘；：”“’。，、？\\]"""
MOBILE = (r"^((13[0-9])|(14[0-1,4-9])|(15[0-3,5-9])|(16[2,5-7])|(17[0-8])"
          r"|(18[0-9])|(19[0-3,5-9]))\d{8}$")
ID_CARD_18 = (r"^[1-9][0-9]{5}(18|19|20)[0-9]{2}((0[1-9])|(10|11|12))"
              r"(([0-2][1-9])|10|20|30|31)[0-9]{3}([0-9]|(X|x))$")
ID_CARD_15 = r"^[1-9]\d{7}((0\d)|(1[0-2]))(([0-2]\d)|3[0-1])\d{3}$"
IPV4 = (r"^((25[0-5]|2[0-4]\d|((1\d{2})|([1-9]?\d)))\.){3}"
        r"(25[0-5]|2[0-4]\d|((1\d{2})|([1-9]?\d)))$")
DIGIT_LIST = r"^(\d+,)*\d+$"
AREA_FIRST, AREA_LAST = 6101, 6112


def has_special_character(value) -> Column:
    """Some special character occurs anywhere in a non-empty text."""
    return _matches(value, SPECIAL_CHARACTERS)


def is_mobile(value) -> Column:
    return _is_all(value, MOBILE)


def is_id_card(value) -> Column:
    """An identity number of 18 or 15 places."""
    return _is_all(value, ID_CARD_18) | _is_all(value, ID_CARD_15)


def is_ipv4(value) -> Column:
    return _is_all(value, IPV4)


def is_known_area(value) -> Column:
    return F.coalesce(_col(value).between(AREA_FIRST, AREA_LAST), F.lit(False))


def is_number_list(value) -> Column:
    """Digits, or several groups of digits separated by commas."""
    return _is_all(value, DIGIT_LIST)


def is_blank(value) -> Column:
    """Null, empty or white space only."""
    return F.coalesce(F.length(F.trim(_col(value))) == 0, F.lit(True))


def _matches(value, pattern: str) -> Column:
    return F.coalesce(_col(value).rlike(pattern), F.lit(False))


def _is_all(value, pattern: str) -> Column:
    """The whole text matches; "$" alone would let a line end pass behind it."""
    return _matches(value, pattern.removesuffix("$") + r"\z")


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value

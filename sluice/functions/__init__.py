"""Column expressions (JVM-side, codegen'd) shared by the operators."""

from sluice.functions.lists import explode_list, explode_list_rows, parse_list_text
from sluice.functions.time import day_of, month_end, month_start, seconds_between, year_month
from sluice.functions.convert import text_to_bool, text_to_int
from sluice.functions.records import decode_json, encode_json

__all__ = [
    "explode_list", "explode_list_rows", "parse_list_text", "day_of", "month_end", "month_start",
    "seconds_between", "year_month", "text_to_bool", "text_to_int", "decode_json",
    "encode_json",
]

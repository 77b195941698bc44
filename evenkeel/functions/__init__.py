from evenkeel.functions.binning import bin_number, segment_number
from evenkeel.functions.numeric import clip, is_present, nan_to_null, without_nan
from evenkeel.functions.text import currency, mask_middle, percent, title_label

__all__ = [
    "bin_number",
    "clip",
    "currency",
    "is_present",
    "mask_middle",
    "nan_to_null",
    "percent",
    "segment_number",
    "title_label",
    "without_nan",
]

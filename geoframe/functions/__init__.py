"""Column functions: geometry structs (``geometry``) and value decoders of
the file encoding (``columns``)."""

from geoframe.functions.columns import (bbox_decode, complete_part_counts, delta_decode_array,
                                        delta_encode_array, dequantize, dequantize_point,
                                        guid_text, ole_days_to_timestamp, quantize,
                                        quantize_point, timestamp_to_ole_days)
from geoframe.functions.geometry import (get_m, get_x, get_y, get_z, geometry_text, point,
                                         point_m, point_to_line, point_z, point_zm, poly,
                                         poly_from_coords, polygon, polyline, polyline_m,
                                         register_sql_functions, translate)

__all__ = [
    "bbox_decode", "complete_part_counts", "delta_decode_array", "delta_encode_array",
    "dequantize", "dequantize_point", "guid_text", "ole_days_to_timestamp", "quantize",
    "quantize_point", "timestamp_to_ole_days", "get_m", "get_x", "get_y", "get_z",
    "geometry_text", "point", "point_m", "point_to_line", "point_z", "point_zm", "poly",
    "poly_from_coords", "polygon", "polyline", "polyline_m", "register_sql_functions",
    "translate",
]

from .geo import EARTH_RADIUS_KM, haversine_km, haversine_km_arrays
from .stac import item_bbox, item_time_extent, number_prop, string_list, string_prop
from .status import retrieval_status
from .text import (
    collection_by_split,
    dataset_by_prefix,
    dataset_by_split,
    dataset_path,
    normalize_segment,
    org_from_collection,
    qualify_collection,
    resolve_ipfs_uri,
    strip_ipfs,
    variant_by_prefix,
    variant_by_split,
)
from .timing import coerce_time, normalize_time_range, normalized_time_range, to_comparable, within_time

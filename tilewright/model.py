"""Schemas of the persistent tables and the geometry of tiles and patches."""

from __future__ import annotations

# Pixels and metres of the imagery, the elevation model and the patches.
TILE_SIZE_PX = 640
OVERLAP_PX = 210
TARGET_RES = 0.5
RGB_RES = 0.1
DSM_RES = 0.5
FUSION_CHANNEL = 1
TILE_PX_DSM = 2000
TILE_PX_RGB = 10000
NEIGHBOR_STRIP_DSM = 360
NEIGHBOR_STRIP_RGB = 1800
DEDUP_RADIUS_M = 7.5

STRIDE_PX = TILE_SIZE_PX - OVERLAP_PX
TILE_GROUND_M = TILE_SIZE_PX * TARGET_RES
STRIDE_GROUND_M = STRIDE_PX * TARGET_RES

DETECTIONS = (
    "tile_id string, patch_id string, easting double, northing double, confidence float, "
    "bbox_w_m float, bbox_h_m float, class_id smallint, rgb_source string, dsm_source string, inserted_at timestamp"
)
PROCESSED_TILES = "tile_id string, n_detections int, skip_reason string, processed_at timestamp"
STAC_CACHE = "bbox string, coord string, rgb_url string, dsm_url string"
STAC_CACHE_META = "bbox string, n_tiles int, cached_at timestamp"
URL_PAIRS = "coord string, rgb_url string, dsm_url string"

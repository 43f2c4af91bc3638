from .match import dgw_flag, match_points, match_result

__all__ = ["dgw_flag", "match_points", "match_result"]

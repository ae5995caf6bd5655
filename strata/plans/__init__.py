from .sizing import broadcast_limit, fits, measure

__all__ = ["broadcast_limit", "fits", "measure"]

from duescope.functions import bands, columns, dates, encoding, weights

__all__ = ["bands", "columns", "dates", "encoding", "weights"]

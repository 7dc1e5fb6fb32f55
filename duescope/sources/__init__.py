from duescope.sources import events, lineitems, sinks, view

__all__ = ["events", "lineitems", "sinks", "view"]

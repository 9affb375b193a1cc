"""Training-data operators (see registry.py for the registered queries)."""

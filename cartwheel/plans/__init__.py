"""Query catalogue (queries.py) and the independent SQL oracle (oracle.py)."""

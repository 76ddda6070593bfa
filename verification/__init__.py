"""The queries once more in plain SQL, to compare results with."""

"""Registered queries, their reference SQL, and the clinical view they run over."""

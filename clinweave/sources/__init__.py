"""Contracts, scans, snapshots, inventories and change streams."""

"""Readers: daily CSV drop folder, machine list, and the facade over the shared test tables."""

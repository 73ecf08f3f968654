"""Real-time e-commerce wide tables as DataFrame transforms.

The same functions serve batch tables and Structured Streaming; only the
device-per-day dedup and the order join have a second, streaming body.
"""

"""Operators: DataFrames in, DataFrames out, many chats at once."""

"""Tests of seatcast.llm (a package, so that its conftest has a name of its own)."""

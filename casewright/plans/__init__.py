"""Composed jobs, the generated case collection and the query registry."""

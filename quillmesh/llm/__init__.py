"""Operators of a pipeline for training data: one module per problem."""

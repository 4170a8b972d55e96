"""Stages that ask a model, with an injected client."""

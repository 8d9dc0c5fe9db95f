"""Batch jobs: operators composed over declared inputs."""

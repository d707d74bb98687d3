"""The batch, speed, serving and full jobs."""

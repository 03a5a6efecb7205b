"""Air-quality reporting tables. Limits, bands, accepted codes and coefficients are inputs."""

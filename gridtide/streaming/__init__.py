"""File streams from the landing area to cleaned tables."""

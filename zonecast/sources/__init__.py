from zonecast.sources.fixture import pitch_view, PITCH_VIEW_SQL  # noqa: F401

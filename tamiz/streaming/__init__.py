"""Row-local steps on streams; global steps per batch."""

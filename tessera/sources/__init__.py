"""Sources and sinks: response shaping, landing files, strict raw loads."""

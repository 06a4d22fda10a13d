from rxsieve.session import SETTINGS, tuned


def test_settings_given_at_run_time_stay(spark):
    (key,) = SETTINGS
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "12345")
        assert tuned(spark).conf.get(key) == "12345"
        spark.conf.unset(key)
        assert tuned(spark).conf.get(key) == SETTINGS[key]
    finally:
        spark.conf.set(key, before)

"""Column names of the telemetry domain."""

KEY = "mapping_uid"
DATE = "date"
LOT = "lot_id"
TIME = "datetime"

# The table names a deployment already uses.
MOTION_TABLE = "motion_bb_mfdotwbdot000001"
QA_TABLE = "qa"

# Numeric sensor columns of the motion table.
SENSORS = tuple("""
    efo_chargetime efo_chargevol efo_currentovershort_1 efo_maxvoltage_1
    efo_maxvoltage_2 efo_maxvoltage_3 efo_meanchangerate_1 efo_meanchangerate_2
    efo_meanchangerate_3 efo_meancurrent_1 efo_meancurrent_2 efo_meancurrent_3
    efo_meanvoltage_1 efo_meanvoltage_2 efo_meanvoltage_3 efo_minvoltage_1
    efo_minvoltage_2 efo_minvoltage_3 efo_risetime_1 efo_risetime_2 efo_risetime_3
    efo_settlingtime_1 efo_settlingtime_2 efo_settlingtime_3 efo_voltagestd_1
    efo_voltagestd_2 efo_voltagestd_3 enhhpwr_maximpedance enhpwr_maxphaseangle
    enhpwr_meanchangerate enhpwr_meancurrent enhpwr_meanimpedance enhpwr_phaselocktime
    enhpwr_rampdowntime enhpwr_risetime enhpwr_settlingtime enh_drivein enh_speed
    fabseatpwr_maximpedance fabseatpwr_maxphaseangle fabseatpwr_meanchangerate
    fabseatpwr_meancurrent fabseatpwr_meanimpedance fabseatpwr_phaselocktime
    fabseatpwr_ramdowntime fabseatpwr_risetime fabseatpwr_settlingtime flat_height
    force_bouncingzoffset_2 force_bouncingzoffset_3 force_bouncingzoffset_4
    force_endzoffset_2 force_endzoffset_3 force_endzoffset_4 force_errstd_2
    force_errstd_3 force_errstd_4 force_maxforce_2 force_maxforce_3 force_maxforce_4
    force_maxzoffsettime_2 force_maxzoffsettime_3 force_maxzoffsettime_4
    force_maxzoffset_2 force_maxzoffset_3 force_maxzoffset_4 force_meanchangerate_2
    force_meanchangerate_3 force_meanchangerate_4 force_meanforce_2 force_meanforce_3
    force_meanforce_4 force_meanzoffset_2 force_meanzoffset_3 force_meanzoffset_4
    force_minforce_2 force_minforce_3 force_minforce_4 force_minzoffsettime_2
    force_minzoffsettime_3 force_minzoffsettime_4 force_minzoffset_2 force_minzoffset_3
    force_minzoffset_4 force_risetime_2 force_risetime_4 force_stdzoffset_2
    force_stdzoffset_3 force_stdzoffset_4 force_settlingtime_2 force_settlingtime_4
    force_totalendzoffset_2 force_totalendzoffset_3 force_totalendzoffset_4 heat_bond
    heat_post heat_pre ref_contactvelocityerror ref_height scrub_dist_3 scrub_maxamp_3
    scrub_minamp_3 scrub_time_3 search_daczmean search_height search_maxsearchdelay
    search_maxvelocityerror search_maxxyposerror search_samplingtime search_searchdelay
    search_speed search_time stbypwr_maximpedance stbypwr_maxphaseangle
    stbypwr_meanchangerate stbypwr_meancurrent stbypwr_meanimpedance
    stbypwr_phaselocktime stbypwr_risetime stbypwr_settlingtime tail_ht tail_htime
    touch_height touch_time usg_maximpedance_2 usg_maximpedance_3 usg_maximpedance_4
    usg_maxphaseangle_3 usg_maxphaseangle_4 usg_meanchangerate_2 usg_meanchangerate_3
    usg_meanchangerate_4 usg_meancurrent_2 usg_meancurrent_3 usg_meancurrent_4
    usg_meanimpedance_2 usg_meanimpedance_3 usg_meanimpedance_4 usg_on_2
    usg_phaselocktime_2 usg_phaselocktime_3 usg_phaselocktime_4 usg_rampdowntime_4
    usg_risetime_2 usg_risetime_3 usg_risetime_4 usg_settlingtime_2 usg_settlingtime_3
    usg_settlingtime_4 xpower_amplitude_4 xpower_frequency_4 zsoftrelease_ht
    zsoftrelease_time bond_position_x bond_position_y wire_angle wire_length row_no
    create_force_endposition_2 create_force_endposition_3 create_force_endposition_4
    create_ref_touch create_force_totalzoffset_max create_efo_area
    create_efo_firstovershoot create_efo_totaltime_1 create_efo_totaltime_2
    create_efo_totaltime_3
""".split())

# Measurement items of the long QA table.
QA_ITEMS = tuple("""
    ball_shear neck_pull wire_pull stitch_pull outer_ball_size_x outer_ball_size_y
    inner_ball_size_x inner_ball_size_y outer_ball_shape inner_ball_shape
    ball_placement_x ball_placement_y al_squeeze_out_x al_squeeze_out_y ball_thickness
    loop_height anomaly_bb anomaly_bs
""".split())

# Model targets, scope measurements before gauge measurements.
SCOPE_TARGETS = tuple("""
    al_squeeze_out_x al_squeeze_out_y outer_ball_size_x outer_ball_size_y
    ball_thickness loop_height outer_ball_shape inner_ball_shape
""".split())
GAUGE_TARGETS = tuple("ball_shear wire_pull neck_pull stitch_pull".split())
TARGETS = SCOPE_TARGETS + GAUGE_TARGETS

# Default features of the models, and columns parsed as timestamps on reload.
MODEL_FEATURES = ("equipment_id", "lf_id", "proc_datetime", "heat_pre")
TIMESTAMPS = ("datetime", "proc_datetime", "date")
